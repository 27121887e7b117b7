"""Substring, line and near dedup, decontamination, licenses: against brute force, and on odd input."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import decontaminate, license_scan, line_dedup, near_dedup, substring_dedup
from millrace.llm.words import ALNUM, SPACED, Words, spans, windows

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALPHA = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string"


def frame(spark, rows, fields=DOCS):
    return spark.createDataFrame(rows, fields)


def random_docs(seed, n, vocabulary=12, most=40):
    rng = random.Random(seed)
    words = [f"w{i}" if i % 3 else f"É{i}" for i in range(vocabulary)]
    docs = [" ".join(rng.choice(words) for _ in range(rng.randint(0, most))) for _ in range(n)]
    docs += [docs[i] for i in range(0, n, 7)] + [f"{docs[i]}\n{docs[i + 1]}\t{docs[i + 2]}" for i in range(0, n - 3, 5)]
    return list(enumerate(docs))


# ---- words ----


def test_words_are_those_of_the_patterns():
    texts = ["", None, " a  B\tç\n", "x" * 5000, "no-break x　y", "A1-b_c é", "\x85a", "last"]
    for table, pattern in ((SPACED, SPACE), (ALNUM, ALPHA)):
        w = Words(pa.array(texts, pa.string()).slice(1), table, lower=True)
        for i, t in enumerate(texts[1:]):
            own = pattern.findall((t or "").translate(LOWER) if table is ALNUM else (t or ""))
            got = [w.buf[a:b].tobytes().decode() for a, b in zip(w.starts[w.first[i] : w.first[i + 1]], w.ends[w.first[i] : w.first[i + 1]])]
            assert [x.translate(LOWER) for x in got] == [x.translate(LOWER) for x in own]


def test_hashes_depend_on_the_word_alone():
    text = " ".join(["ab", "b", "AB", "abc" * 1000, "é"] * 60000)
    w = Words(pa.array([text, "ab", "é"], pa.string()), SPACED, lower=True)
    h = w.hashes
    assert len(set(h.tolist())) == 4 and h[0] == h[2] == h[-2] and h[4] == h[-1]
    five = windows(h[:-2], 5)
    assert len(np.unique(five)) == 5
    assert [x.tolist() for x in spans(np.array([True, False, True, True]))] == [[0, 2], [1, 4]]


# ---- substring dedup ----


def brute_substrings(docs, window):
    words = {i: SPACE.findall(t or "") for i, t in docs}
    seen = Counter(tuple(w[k : k + window]) for w in words.values() for k in range(len(w) - window + 1))
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone.update(range(k, k + window))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


@pytest.mark.parametrize("window,batch", [(5, 300), (4, 4 << 20), (1, 500), (7, 1000)])
def test_substrings_against_brute_force(spark, window, batch):
    docs = random_docs(window, 60, vocabulary=25 if window > 1 else 900)
    got = substring_dedup.dedup_substrings(frame(spark, docs), window=window, batch_bytes=batch).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in got} == brute_substrings(docs, window)
    for r in got:
        assert sum(s.end_word - s.first_word for s in r.spans) == r.n_removed


def test_substrings_odd_input(spark):
    rows = [(1, None, 0), (2, "", 0), (None, "a b c", 0), (None, "a b c", 0), (3, "la la la la la", 0), (4, "x y", 0), (4, "x y", 0)]
    got = substring_dedup.dedup_substrings(frame(spark, rows, "doc_id long, text string, n_words int"), window=3).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append((r.n_words, r.n_removed, r.kept_text))
    assert by[1] == by[2] == [(0, 0, "")] and by[None] == [(3, 3, "")] * 2 and by[3] == [(5, 5, "")] and by[4] == [(2, 0, "x y")] * 2
    assert substring_dedup.dedup_substrings(frame(spark, []), window=3).count() == 0


def test_substrings_of_a_very_long_text(spark):
    rng = random.Random(1)
    long = [str(rng.random()) for _ in range(60000)]
    docs = [(1, " ".join(long)), (2, "start " + " ".join(long[1000:1100]) + " end")]
    got = {r.doc_id: r for r in substring_dedup.dedup_substrings(frame(spark, docs), window=35, batch_bytes=1 << 16).collect()}
    assert (got[1].n_removed, got[2].n_removed, got[2].kept_text) == (100, 100, "start end")


# ---- line dedup ----


def brute_lines(docs, chars=6, least=3):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = defaultdict(set)
    for i, t in docs:
        for x in (t or "").split("\n"):
            holders[key(x)].add(i)
    common = {k: max(v) for k, v in holders.items() if len(k) >= chars and len(v) >= least}
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if common.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def test_lines_against_brute_force(spark):
    rng = random.Random(3)
    pool = ["common line", " Common LINE\t", "éCOMMON", "Écommon", "short", "", "one of them all", "\x0bone OF them all\r", "x" * 3000]
    docs = [(i, "\n".join(rng.choice([*pool, f"own {i} line {rng.random()}"]) for _ in range(rng.randint(0, 8)))) for i in range(80)]
    docs += [(200, None), (201, ""), (202, "\n\n"), docs[0], docs[0]]
    got = line_dedup.dedup_lines(frame(spark, docs), min_chars=6, min_docs=3)
    assert sorted(map(tuple, got.select("doc_id", "n_lines", "n_dropped", "kept_text").collect())) == brute_lines(docs)


def test_lines_odd_input(spark):
    rows = [(None, "the very same line", 1), (1, "the very same line", 1), (2, "the very same line", 1)]
    got = line_dedup.dedup_lines(frame(spark, rows, "doc_id long, text string, N_Lines int"), min_docs=3, min_chars=5)
    assert sorted(got.columns) == ["doc_id", "kept_text", "n_dropped", "n_lines", "text"]
    assert {r.doc_id: r.n_dropped for r in got.collect()} == {None: 1, 1: 1, 2: 0}
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0


def test_lines_with_clashing_names_and_of_a_very_long_text(spark):
    long = "\n".join(f"line number {i} of all these" for i in range(100_000))
    rows = [(i, long if i < 3 else f"own {i}\nline number 7 of all these", 1, 2, {"k": 3}) for i in range(5)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, __n int, __kept int, _h map<string,int>")).orderBy("doc_id").collect()
    assert [(r.n_lines, r.n_dropped, r["__n"], r["__kept"], r["_h"]) for r in got] == [(100_000, 100_000, 1, 2, {"k": 3})] * 2 + [(100_000, 1, 1, 2, {"k": 3})] + [(2, 1, 1, 2, {"k": 3}), (2, 0, 1, 2, {"k": 3})]
    assert got[0].kept_text == "" and got[2].kept_text.count("\n") == 99_998 and got[3].kept_text == "own 3"


# ---- near dedup ----


def brute_components(docs, width, percent=80):
    sets = {}
    for i, t in docs:
        w = SPACE.findall((t or "").translate(LOWER))
        sets.setdefault(i, []).append({tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if any(a and b and 100 * len(a & b) >= percent * len(a | b) for a in sets[i] for b in sets[j]):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def near_copies(seed, n, length=40):
    rng = random.Random(seed)
    docs = []
    for i in range(n):
        if docs and rng.random() < 0.7:
            words = rng.choice(docs).split()
            for _ in range(rng.randint(0, 5)):
                words[rng.randrange(len(words))] = f"e{rng.random()}"
            docs.append(" ".join(words))
        else:
            docs.append(" ".join(f"W{rng.randrange(3000)}" for _ in range(length)))
    return list(enumerate(docs, 10))


@pytest.mark.parametrize("width,seed,block", [(2, 1, 512), (5, 2, 2)])
def test_near_duplicates_against_brute_force(spark, width, seed, block):
    docs = near_copies(seed, 160)
    got = near_dedup.near_duplicates(frame(spark, docs), shingle_words=width, block=block).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(docs, width)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_odd_input(spark):
    rows = [(5, "one"), (6, "ONE "), (7, None), (8, ""), (9, " "), (None, "one"), (None, None), (None, "alone here"), (6, "two words more"), (3, "two words more"), (6, "ONE ")]
    got = near_dedup.near_duplicates(frame(spark, [(*r, 1) for r in rows], "doc_id long, text string, component_id int"), shingle_words=2).collect()
    assert len(got) == len(rows)
    found = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got)
    # 6 comes with two texts, which are judged apart.
    assert found == Counter({(5, 1, 5, True): 1, (6, 1, 5, False): 2, (6, 2, 3, False): 1, (3, 2, 3, True): 1, (7, 0, 7, True): 1, (8, 0, 8, True): 1, (9, 0, 9, True): 1, (None, 1, 5, False): 1, (None, 0, None, True): 1, (None, 1, None, True): 1})
    assert near_dedup.near_duplicates(frame(spark, [])).count() == 0


def crowded(spark, rows, block):
    """Links of rows (id, component, text, values of one tree), of regions of one value or more."""
    signed = [(i, np.array(values, dtype=">u4").tobytes(), comp) for i, comp, _, values in rows]
    labelled, texts = frame(spark, signed, "id long, sign binary, comp long"), frame(spark, [(i, t) for i, _, t, _ in rows], "id long, text string")
    return near_dedup._crowded(labelled, texts, 1, len(rows[0][3]), 1, 80, 1, block)


@pytest.mark.parametrize("block", [1, 2, 512])
def test_outsiders_of_a_crowded_region_all_meet_each_other(spark, block):
    rows = [(i, 1, f"main {i}", (1, 10)) for i in range(1, 10)] + [(20 + i, 20 + i, f"a b c d e{i % 4}" if i < 8 else f"own {i}", (1, 20 + i)) for i in range(10)]
    several = [*rows, (40, 40, "p q r s t u v w x y", (1, 1)), (41, 41, "p q r s t u v w x", (1, 2)), (42, 42, "q r s t u v w x y", (1, 3)), (43, 43, "main 4", (1, 4))]
    assert {r.id: r.root for r in near_dedup.components(crowded(spark, several, block)).collect()} == {24: 20, 25: 21, 26: 22, 27: 23, 41: 40, 42: 40, 43: 4}


def test_thousands_of_outsiders(spark):
    rows = [(i, 0, f"main {i}", (1, 1)) for i in range(2000)] + [(2000 + i, 2000 + i, f"a b c d e f g h w{i % 1000} x{i % 1000}", (1, 1)) for i in range(1500)]
    rows = [(i, c, t if i < 2000 else " ".join([*(f"v{i % 1000}w{k}" for k in range(8)), "y"]), v) for i, c, t, v in rows]
    found = {r.id: r.root for r in near_dedup.components(crowded(spark, rows, 512)).collect()}
    assert found == {3000 + i: 2000 + i for i in range(500)}


def test_components_of_a_long_chain(spark):
    links = spark.range(1, 300).select((F.col("id") - 1).alias("a"), F.col("id").alias("b"))
    got = near_dedup.components(links.unionByName(spark.createDataFrame([(1000, 999)], "a long, b long"))).collect()
    assert {r.id: r.root for r in got} == {**dict.fromkeys(range(1, 300), 0), 1000: 999}


# ---- decontamination ----


def brute_hits(docs, items, window=8):
    out = []
    grams = []
    for item, text in items:
        w = ALPHA.findall((text or "").translate(LOWER))
        k = min(window, len(w))
        if k and item is not None:
            grams += [(str(item), tuple(w[j : j + k])) for j in range(len(w) - k + 1)]
    for i, text in docs:
        w = ALPHA.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for item, g in grams:
            for j in range(len(w) - len(g) + 1):
                if tuple(w[j : j + len(g)]) == g:
                    hit.update(range(j, j + len(g)))
                    found.add(item)
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(found) >= 2))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_contamination_against_brute_force(spark, block):
    docs = random_docs(9, 50, vocabulary=6)
    items = [(1, "w1 w2 w4 W5"), (10, "É0 w1"), (2, "w5, w5; w5 w5. w4 w4"), (3, "w1"), (4, None), (5, ""), (6, "unknown"), (None, "w1 w2"), (7, " ".join(docs[3][1].split()[:12])), (8, " ".join(docs[3][1].split()[:12]))]
    docs += [(900, None), (901, ""), (None, "w1 w2 w4 w5"), docs[3], docs[3]]
    bench = frame(spark, items, "item_id long, text string")
    got = decontaminate.find_contamination(frame(spark, docs).withColumn("N_hit", F.lit(1)), bench, window=4, block_bytes=block)
    rows = sorted(map(tuple, got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=str)
    assert rows == brute_hits(docs, items, 4)
    assert {(r.doc_id, r.longest_match, tuple(map(tuple, r.matches))) for r in got.collect()} == brute_matches(docs, items, 4)
    for r in got.collect():
        assert sum(m.end_word - m.first_word for m in r.spans) == r.n_hit


def brute_matches(docs, items, window=8):
    """Of each document and item: the longest run of words alike, the first in the document, then in the item."""
    out = set()
    parts = [(str(i), w, min(window, len(w))) for i, t in items if i is not None for w in [ALPHA.findall((t or "").translate(LOWER))] if w]
    for i, text in docs:
        w = ALPHA.findall((text or "").translate(LOWER))
        best = {}
        for item, own, least in parts:
            for a in range(len(w)):
                for b in range(len(own)):
                    n = 0
                    while a + n < len(w) and b + n < len(own) and w[a + n] == own[b + n]:
                        n += 1
                    if n >= least:
                        best[item] = min(best.get(item, (-n, a, b)), (-n, a, b))
        out.add((i, max((-n for n, *_ in best.values()), default=0), tuple((k, b, a, -n) for k, (n, a, b) in sorted(best.items()))))
    return out


def test_matches_of_two_items_next_to_each_other_stay_apart(spark):
    one, two = [f"a{i}" for i in range(20)], [f"b{i}" for i in range(20)]
    docs = [(1, " ".join(["x", *one[12:], *two[:8], "y"])), (2, " ".join(one[3:19]))]
    got = decontaminate.find_contamination(frame(spark, docs), frame(spark, [(1, " ".join(one)), (2, " ".join(two))], "item_id long, text string"), min_items=1).orderBy("doc_id").collect()
    assert [(r.n_hit, r.longest_match) for r in got] == [(16, 8), (16, 16)]
    assert [list(map(tuple, r.matches)) for r in got] == [[("1", 12, 1, 8), ("2", 0, 9, 8)], [("1", 3, 0, 16)]]


@pytest.mark.parametrize("block", [1 << 20, 30])
def test_contamination_with_clashing_names_and_maps(spark, block):
    docs = spark.createDataFrame([(1, "a b c d e f g h i", 7, 8, {"k": 1}, 9), (1, "a b c d e f g h i", 7, 8, {"k": 1}, 9)], "doc_id long, text string, m int, _copies int, _n map<string,int>, __row int")
    bench = frame(spark, [(1, "a b c d e f g h"), (2, "b c d e f g h i j"), (3, "z " * 9)], "item_id long, text string")
    got = decontaminate.find_contamination(docs, bench, block_bytes=block).collect()
    assert [(r.m, r["_copies"], r["_n"], r["__row"], r.n_hit, r.n_items) for r in got] == [(7, 8, {"k": 1}, 9, 9, 2)] * 2


def test_contamination_of_a_very_long_text_and_a_common_passage(spark, monkeypatch):
    common = " ".join(f"c{i}" for i in range(12))
    items = [(i, f"{common} own{i} " + " ".join(f"i{i}w{j}" for j in range(10))) for i in range(40)]
    long = " ".join(f"w{i}" for i in range(50000)) + f" {common} " + items[7][1]
    monkeypatch.setattr(decontaminate, "_MOST_PAIRS", 3)
    got = decontaminate.find_contamination(frame(spark, [(1, long), (2, common)]), frame(spark, items, "item_id long, text string")).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_items, r.longest_match) for r in got] == [(50035, 40, 23), (12, 40, 12)]
    assert {(m.item, m.item_word, m.first_word, m.words) for m in got[0].matches} == {(str(i), 0, 50000, 12) if i != 7 else ("7", 0, 50012, 23) for i in range(40)}


def test_contamination_of_empty_tables(spark):
    bench = frame(spark, [], "item_id long, text string")
    assert decontaminate.find_contamination(frame(spark, []), bench).count() == 0
    assert [r.n_items for r in decontaminate.find_contamination(frame(spark, [(1, "a b")]), bench).collect()] == [0]
    assert decontaminate.decontaminate(frame(spark, [(1, "a b c"), (2, "x")]), frame(spark, [(1, "a b c")], "item_id long, text string"), min_items=1).collect() == [(2, "x")]


def test_suffix_array_search():
    h = np.array([5, 3, 5, 3, 9, 5, 3, 1, 1], dtype=np.uint64)
    suffixes = decontaminate.suffix_array(h, np.arange(7), 3)
    test = np.array([5, 3, 5, 3, 9, 7, 7, 7, 9, 5, 3], dtype=np.uint64)
    lo, hi = decontaminate.search(h, suffixes, test, np.array([0, 2, 5, 8]), 3)
    assert [sorted(suffixes[a:b].tolist()) for a, b in zip(lo, hi)] == [[0], [2], [], [4]]


# ---- licenses ----

TEMPLATES = (("alpha beta gamma delta epsilon", "greek"), ("released under the mit license", "mit"), ("alpha alpha", "a"))


def brute_licenses(text, threshold=0.8):
    words = [(m.start(), m[0]) for m in ALPHA.finditer((text or "").translate(LOWER))]
    only = [w for _, w in words]
    places, base, labels, score = [], set(), set(), 0.0
    for phrase, label in license_scan.PHRASES:
        p = phrase.split()
        for k in range(len(only) - len(p) + 1):
            if only[k : k + len(p)] == p:
                places.append(k)
                base.add(label)
    for template, label in TEMPLATES:
        t = template.split()
        step, grams = license_scan.step_of(len(t)), set(zip(t, t[1:]))
        for k in range(0, len(only), step):
            block = only[k : k + 2 * step]
            held = len(grams & set(zip(block, block[1:]))) / len(grams)
            if held >= threshold:
                labels.add(label)
                score = max(score, held)
    return (len(only), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)), 1.0 if places else score)


def test_licenses_against_brute_force(spark):
    rng = random.Random(4)
    pool = "alpha beta gamma delta Epsilon released under the MIT license CC BY General Public License all rights reserved é x".split()
    texts = [None, "", "CC-BY, cc.by 4.0", "ccby", "all\nrights\n reserved", "Alpha, beta! gamma\ndelta", "alpha beta\n\ngamma delta epsilon", "alpha beta\n - \ngamma delta", "released under MIT license"]
    texts += ["".join(rng.choice(pool) + rng.choice([" ", " ", "\n", "\n\n", "-"]) for _ in range(rng.randint(1, 30))) for _ in range(200)]
    docs = frame(spark, [*enumerate(texts), (7, texts[7]), (None, "alpha")]).withColumn("LABELS", F.lit("old"))
    got = license_scan.scan_licenses(docs, templates=TEMPLATES)
    assert got.count() == len(texts) + 2
    for r in got.where("doc_id is not null").collect():
        row = (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score)
        assert row == brute_licenses(texts[r.doc_id]), texts[r.doc_id]
    assert license_scan.scan_licenses(frame(spark, [])).count() == 0


def edited(words, rate, rng):
    out = []
    for w in words:
        out += [] if rng.random() < rate / 2 else [w, "inserted"] if rng.random() < rate / 2 else [w]
    return out


def test_notices_are_found_and_prose_is_not(spark):
    """Every notice, whole or edited a little, at any place of a text; prose of the notices' own words has no label."""
    rng = random.Random(8)
    notices = license_scan.NOTICES
    vocabulary = sorted({w for text, _ in notices for w in ALPHA.findall(text.lower())})
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    rows = []
    for text, label in notices:
        words = ALPHA.findall(text.translate(LOWER))
        for rate in (0, 0, 0.05 if len(words) > 60 else 0):
            rows.append((len(rows), " ".join([*prose(rng.randrange(300)), *edited(words, rate, rng), *prose(200)]), label))
    rows += [(len(rows) + i, " ".join(prose(2000)), "") for i in range(60)]
    rows.append((len(rows), "The prisoners were released on Monday under a new rule; the driver lost the license he had.", ""))
    rows.append((len(rows), "Our shop is licensed. Delivery by car under section 4, see 0 and cc list.", ""))
    got = {r.doc_id: r for r in license_scan.scan_licenses(frame(spark, [r[:2] for r in rows])).collect()}
    for i, text, label in rows:
        assert label in got[i].labels.split(",") if label else not set(got[i].labels.split(",")) - set(got[i].base_labels.split(",")), (text[:80], label, got[i].labels)
        assert label or got[i].score in (0.0, 1.0)


def test_long_notices_and_long_texts(spark):
    rng = random.Random(9)
    notice = " ".join(f"n{rng.randrange(10**6)}" for _ in range(1000))
    words = [f"w{i}" for i in range(50_000)]
    texts = [notice, " ".join(words[:777] + [notice] + words[777:]), " ".join(words), " ".join(notice.split()[:700])]
    got = license_scan.scan_licenses(frame(spark, list(enumerate(texts))), templates=((notice, "long"), ("one", "word"))).orderBy("doc_id").collect()
    assert [(r.labels, r.score) for r in got] == [("long", 1.0), ("long", 1.0), ("", 0.0), ("", 0.0)]
