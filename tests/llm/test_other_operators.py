"""URL filters, language ID, sharding, vector search and mixing; the subpackage's queries; the pipeline."""

import hashlib
import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import common, language_id, mixing, oracles, queries, sharding, url_filters, vector_search
from millrace.llm.words import mix

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")


# ---- URL filters ----

RULES = [*[url_filters.prefix_rule(*r) for r in queries.URL_RULES], *url_filters.DEFAULT_PATTERNS]
URLS = [
    (1, "http://a.example.com/en/7198?x", "a.example.com", "/en/7198", "example.com/en/7", "allow"),
    (2, "HTTPS://A.Example.COM/en/8", "a.example.com", "/en/8", "com/en/", "block"),
    (3, "http://example.com.evil.net/de/81#x", "example.com.evil.net", "/de/81", "net/de/", "allow"),
    (4, "x://example.net/de/81/9", "example.net", "/de/81/9", "example.net/de/8", "block"),
    (5, "http://notexample.net/de/8", "notexample.net", "/de/8", "net/de/", "allow"),
    (6, "http://org/es/", "org", "/es/", "org/es/", "block"),
    (7, "http://x.org/ES/", "x.org", "/ES/", None, "allow"),
    (8, "http://ads.x.fr/page", "ads.x.fr", "/page", None, "block"),
    (9, "http://x.fr/threads/", "x.fr", "/threads/", None, "allow"),
    (10, None, "", "", None, "allow"),
    (11, "", "", "", None, "allow"),
    (12, "a.com/en/", "", "", None, "allow"),
    (13, "http://a.com:80/en/", "a.com:80", "/en/", None, "allow"),
    (14, "http://b.com#x://c.org/es/", "b.com", "", None, "allow"),
    (14, "http://b.com#x://c.org/es/", "b.com", "", None, "allow"),
    (None, "http://b.com/en/", "b.com", "/en/", "com/en/", "block"),
]


@pytest.mark.parametrize("indexed", [2000, 0])
def test_url_rules(spark, indexed):
    pages = spark.createDataFrame([(i, u, "old") for i, u, *_ in URLS], "page_id long, url string, Rule string")
    got = url_filters.filter_urls(pages, RULES, max_indexed=indexed)
    rows = [(r.page_id, r.url, r.host, r.path, r.rule, r.verdict) for r in got.collect()]
    assert Counter(rows) == Counter(URLS)
    assert url_filters.filter_urls(pages.limit(0), RULES, max_indexed=indexed).count() == 0
    clash = pages.limit(1).selectExpr("*", "1 AS __place", "2 AS __rule", "3 AS __hits", "4 AS __pattern", "5 AS __url")
    assert [tuple(r)[2:7] for r in url_filters.filter_urls(clash, RULES, max_indexed=indexed).collect()] == [(1, 2, 3, 4, 5)]
    long = spark.createDataFrame([(1, "http://a.com/en/" + "x/y-" * 50000)], "page_id long, url string")
    assert [(r.rule, len(r.path)) for r in url_filters.filter_urls(long, RULES, max_indexed=indexed).collect()] == [("com/en/", 200_004)]
    assert [r.verdict for r in url_filters.filter_urls(pages.limit(1), []).collect()] == ["allow"]


def test_rarest_token_indexes_a_rule(spark):
    pages = spark.createDataFrame([(f"http://x.com/en/{i}",) for i in range(9)] + [("http://x.com/fr/rare/",)], "url string")
    rules = [url_filters.prefix_rule("block", "com/en/"), url_filters.prefix_rule("block", "x.com/fr/rare/"), url_filters.prefix_rule("block", "example.com/en/7")]
    index = url_filters.rarest_tokens(pages, rules)
    assert index[0] == "en" and index[1] in ("fr", "rare") and index[2] == "example"


# ---- language ID ----


def texts_of(lang, n, seed):
    rng = random.Random(seed)
    words = {"aa": "the of and thing with".split(), "bb": "der und ße über mit".split(), "cc": "猫 犬 鳥 魚 空".split()}[lang]
    return ["".join(rng.choice(words) + rng.choice([" ", ", ", "\n"]) for _ in range(rng.randint(3, 40))) for _ in range(n)]


def test_language_of_held_out_texts(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate((t, lang) for lang in ("aa", "bb", "cc") for t in texts_of(lang, 60, lang))]
    odd = [(900, None, "aa"), (901, "", "bb"), (902, "123 !?", "cc"), (903, "the of and", None), (None, "der und", None), (904, "über und mit " * 100000, None), (904, "über und mit", None)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows + odd], "doc_id long, text string, lang string, SCORE double")
    got = language_id.identify(docs).collect()
    assert len(got) == len(rows) + len(odd)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, r)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode() if r.doc_id is not None else b"") % 4 == 2) and 0 <= r.score <= 1
    assert all(by[i].lang_pred == lang for i, _, lang in rows)
    assert [by[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and by[900].score == 0
    assert (by[903].lang_pred, by[None].lang_pred, by[904].lang_pred) == ("aa", "bb", "bb")


def brute_posteriors(rows, features=1 << 16, alpha=0.1):
    """Plain naive Bayes over hashed n-grams: (label, posterior) of each text."""

    def grams(text):
        low, out = f" {text.lower()} ", []
        for k in (2, 3):
            for at in range(len(low) - k + 1):
                h = k
                for c in low[at : at + k]:
                    h = (h * 0x9E3779B97F4A7C15 + ord(c)) % 2**64
                out.append(int(mix(np.array([h], dtype=np.uint64))[0]) % features)
        return out

    counts, docs = {}, Counter()
    for i, t, lang in rows:
        if lang is not None and t is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            counts.setdefault(lang, Counter()).update(grams(t))
            docs[lang] += 1
    out = []
    for _, t, _ in rows:
        if not any(c.isalpha() for c in t or ""):
            out.append(("und", 0.0))
            continue
        logs = {}
        for lang in sorted(counts):
            total = sum(counts[lang].values()) + alpha * features
            logs[lang] = math.log(docs[lang] / sum(docs.values())) + sum(math.log((counts[lang][g] + alpha) / total) for g in grams(t))
        best = max(logs, key=lambda x: (logs[x], [-ord(c) for c in x]))
        out.append((best, 1 / sum(math.exp(v - logs[best]) for v in logs.values())))
    return out


def test_posteriors_against_brute_force(spark):
    rng = random.Random(6)
    words = {"aa": "the of and thing".split(), "bb": "the of and thong".split(), "cc": "the of og thing".split()}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(rng.randint(1, 2))), lang) for i, lang in enumerate(rng.choice(["aa", "bb", "bb", "cc"]) for _ in range(120))]
    rows += [(500, "of", "aa"), (501, "zzz", None), (502, "... 7", "aa"), (503, None, "bb")]
    got = {r.doc_id: r for r in language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    want = brute_posteriors(rows)
    assert 10 < sum(0.34 < p < 0.95 for _, p in want)
    for (i, _, _), (label, p) in zip(rows, want):
        assert got[i].lang_pred == label and got[i].score == pytest.approx(p, abs=1e-4), (rows[i], got[i])


def test_ties_go_to_the_smallest_label(spark):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2][:4]
    docs = spark.createDataFrame([(i, "same words", lang) for i, lang in zip(ids, ("b", "a", "b", "a"))], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in language_id.identify(docs).collect()] == [("a", 0.5)] * 4


def test_any_number_of_labels(spark):
    ids = [i for i in range(900) if zlib.crc32(str(i).encode()) % 4 != 2][:300]
    docs = spark.createDataFrame([(i, f"word{i} " * 20, f"l{i}") for i in ids], "doc_id long, text string, lang string")
    got = language_id.identify(docs, max_cells=300 * 4096).collect()
    assert sum(r.lang_pred == r.lang for r in got) > 290


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in language_id.identify(docs).collect()] == [("und", 0.0)]
    assert language_id.identify(docs.limit(0)).count() == 0


def test_pieces_hold_every_ngram_once(monkeypatch):
    texts = ["", "ab", "x" * 50, "".join(random.Random(1).choice("abcé猫") for _ in range(333))]

    def count():
        total = [Counter() for _ in texts]
        for points, starts, owners in language_id._pieces(texts, 3):
            for k, (h, piece) in zip((2, 3), language_id._features(points, starts, (2, 3), 1 << 16)):
                for x, p in zip(h.tolist(), piece.tolist()):
                    total[owners[p]][k, x] += 1
        return total

    whole = count()
    assert [sum(c.values()) for c in whole] == [(len(t) + 1) + len(t) for t in texts]
    monkeypatch.setattr(language_id, "_PIECE", 7)
    assert count() == whole


# ---- sharding ----


@pytest.mark.parametrize("bucket", [200, 1 << 20])
def test_shards(spark, bucket):
    rows = [(i, f"text {i} " * (i % 7), i % 3) for i in range(300)] + [(5, "twin", 1), (5, "twin", 1), (None, None, 0), (7, "", 0), (8, "long " * 20000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    got = sharding.shard_records(docs, shards=16, bucket_bytes=bucket).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((i, t) for i, t, _ in rows)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert set(slots) == set(range(16)) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = sharding.shard_records(docs.repartition(3), shards=16, bucket_bytes=bucket).collect()
    key = lambda rs: sorted((r.shard, r.slot, str(r.doc_id), r.text or "") for r in rs)
    assert key(got) == key(again)
    other = sharding.shard_records(docs, shards=16, seed=8, bucket_bytes=bucket).collect()
    assert key(got) != key(other)
    assert sharding.shard_records(docs.limit(0)).count() == 0


def brute_shuffle(rows, shards, seed, buckets):
    """A plain two-pass shuffle of (hash, record): scatter, Fisher-Yates in each bucket, deal in order."""
    scattered = [[] for _ in range(buckets)]
    for h, record in rows:
        scattered[(h >> 16) % buckets].append((h, record))
    order = []
    for b, bucket in enumerate(scattered):
        bucket = [record for _, record in sorted(bucket)]
        places = np.arange(len(bucket))
        np.random.default_rng([seed, b]).shuffle(places)
        order += [bucket[p] for p in places]
    return {record: (k % shards, k // shards) for k, record in enumerate(order)}


@pytest.mark.parametrize("bucket", [500, 1 << 20])
def test_shards_against_a_plain_two_pass_shuffle(spark, bucket):
    docs = spark.createDataFrame([(i, f"text {i} " * (i % 5)) for i in range(200)], "doc_id long, text string")
    hashed = docs.select(F.xxhash64(F.lit(7), "doc_id", "text").alias("h"), "doc_id").collect()
    size = sum(len(f"text {i} " * (i % 5)) for i in range(200)) + 64 * 200
    want = brute_shuffle([(r.h, r.doc_id) for r in hashed], 16, 7, -(-size // bucket))
    assert {r.doc_id: (r.shard, r.slot) for r in sharding.shard_records(docs, shards=16, bucket_bytes=bucket).collect()} == want


def test_shards_with_clashing_names_and_maps(spark):
    docs = spark.createDataFrame([(i, "t", 1, 2, {"k": i}) for i in range(20)], "doc_id long, text string, __bucket int, __spread int, m map<string,int>")
    got = sharding.shard_records(docs, shards=4).collect()
    assert all((r["__bucket"], r["__spread"], r.m) == (1, 2, {"k": r.doc_id}) for r in got) and Counter(r.shard for r in got) == {s: 5 for s in range(4)}


def test_temporary_tables_go(spark):
    with common.temporary(spark):
        gone = common.materialise(spark.range(3), "gone").inputFiles()[0]
        kept = common.materialise(spark.range(3), "kept", keep=True)
    assert kept.count() == 3 and not os.path.exists(gone.removeprefix("file://"))


def test_written_shards(spark, tmp_path):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    sharding.write_shards(docs, str(tmp_path / "out"), shards=4)
    assert sorted(os.listdir(tmp_path / "out"))[-4:] == ["shard=0", "shard=1", "shard=2", "shard=3"]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 100


# ---- vector search ----


def brute_nearest(rows, query, k):
    usable = {}
    for i, v in rows:
        if i is not None and v and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable.setdefault((i, tuple(v)), np.array(v, dtype=np.float64))
    out = {}
    for (q, qt), x in usable.items():
        if query(q):
            found = sorted((-float((x * y).cumsum()[-1] / (np.sqrt((y * y).cumsum()[-1]) * np.sqrt((x * x).cumsum()[-1]))), i) for (i, _), y in usable.items() if i != q)
            out.setdefault(q, []).append(found[:k])
    return out


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((6, 8))
    rows = [(i, (centres[i % 6] + 0.3 * rng.standard_normal(8)).tolist()) for i in range(600)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]  # one vector again and again
    rows += [(2000, None), (2001, [0.0] * 8), (2002, [1.0, None] + [0.0] * 6), (2003, [float("nan")] + [1.0] * 7), (2004, [1.0] * 3), (None, [1.0] * 8), (2005, []), (50, rows[50][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    got = {}
    for r in vector_search.nearest(df, F.col("vec_id") % 50 == 0, k=5, block_rows=64, query_rows=4).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute_nearest(rows, lambda i: i % 50 == 0, 5)
    assert set(got) == set(want) and all([x[0] for x in v] == [1, 2, 3, 4, 5] for v in got.values())
    hits = sum(len({x[1] for x in got[q]} & {i for _, i in want[q][0]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    assert [x[1] for x in got[0]] == [1000, 1001, 1002, 1003, 1004]
    true = {(q, i): -s for q, found in ((q, brute_nearest(rows, lambda i, q=q: i == q, 2000)[q][0]) for q in want) for s, i in found}
    assert all(s == true[q, i] for q, v in got.items() for _, i, s in v)


def test_recall_without_clusters(spark):
    rng = np.random.default_rng(9)
    rows = [(i, x.tolist()) for i, x in enumerate(rng.standard_normal((3000, 32)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    x = np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = vector_search.nearest(df, F.col("vec_id") % 20 == 0, k=10).collect()
    hits = 0
    for q in range(0, 3000, 20):
        near = np.argsort(-(x @ x[q]), kind="stable")
        hits += len(set(near[near != q][:10].tolist()) & {r.vec_id for r in got if r.query_id == q})
    assert len(got) == 1500 and hits >= 0.9 * 1500


def test_very_large_and_very_small_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [1e200, -1e200]), (2, [1e-200, 1e-201]), (3, [-5e-324, 0.0]), (20, [1e300, 1e300])]
    got = vector_search.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=5).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(0, 2), (0, 1), (0, 20), (0, 3), (20, 2), (20, 0), (20, 1), (20, 3)]
    assert [r.score for r in got] == pytest.approx([0.99503719, 0.70710678, 0.70710678, -1, 0.77395730, 0.70710678, 0, -0.70710678], abs=1e-6)


def test_an_id_with_several_vectors_counts_once(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 0.1]), (2, [-1.0, 1.0]), (1, [0.0, -1.0])]
    got = vector_search.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.rank, r.vec_id) for r in got] == [(1, 1), (2, 2)]


def test_few_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.rank, r.vec_id) for r in vector_search.nearest(df, F.col("vec_id") == 0).collect()] == [(0, 1, 1)]
    assert vector_search.nearest(df.limit(0), F.lit(True)).count() == 0
    assert vector_search.nearest(df.limit(1), F.lit(True)).count() == 0


# ---- mixing ----


def allocated(spark, sizes, *args):
    sources = spark.createDataFrame(list(sizes), "s string, n long")
    return {r.s: r.target for r in mixing.allocate(sources, *args).collect()}


def brute_allocate(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, target, left = {s: weights[i % len(weights)] for i, s in enumerate(order)}, {}, share * sum(sizes.values())
    while True:
        free = [s for s in order if s not in target]
        each = sum(weight[s] for s in free) or 1
        over = [s for s in free if left * weight[s] / each > most * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / each for s in free}
        target |= {s: most * sizes[s] for s in over}
        left = share * sum(sizes.values()) - sum(target.values())


def test_allocation(spark):
    assert allocated(spark, [("a", 100), ("b", 100), (None, 100)], (5, 2, 1)) == {"a": 200.0, "b": 250 * 2 / 3, None: 250 / 3}
    assert allocated(spark, []) == {} and allocated(spark, [("a", 0)]) == {"a": 0.0}
    sizes = {f"s{i:02}": 10 * (i + 1) for i in range(20)}
    assert allocated(spark, sizes.items()) == brute_allocate(sizes)


def brute_mix(rows, weights=(5, 2, 1), share=1.5, half=100, seed="mix:", odds=None):
    """(target, copies) of each row (id, text, source): ranks of each source in one sorted list."""
    size = [len((t or "").split()) for _, t, _ in rows]
    sizes = Counter()
    for n, (_, _, s) in zip(size, rows):
        sizes[s] += n
    target = brute_allocate(dict(sizes), weights, share)
    out = [None] * len(rows)
    for s, total in sizes.items():
        own = [k for k, r in enumerate(rows) if r[2] == s]
        whole = int(target[s] // total) if total else 0
        want, steps = target[s] - whole * total, {}
        for k in own:
            i, t, _ = rows[k]
            key = str(i) if i is not None else t or ""
            u = (int(hashlib.md5((seed + key).encode()).hexdigest()[:12], 16) + 0.5) / 2.0**48
            g = (odds[k] if odds else size[k] / (size[k] + half)) if size[k] else 0
            if g:
                steps.setdefault((u / (1 - u) / g, "" if i is None else str(i)), []).append(k)
        best, upto, words = (want, -math.inf), -1, 0
        order = sorted(steps)
        for n, key in enumerate(order):
            words += sum(size[k] for k in steps[key])
            if abs(words - want) < best[0]:
                best, upto = (abs(words - want), key), n
        taken = {k for key in order[: upto + 1] for k in steps[key]} if want > 0 else set()
        for k in own:
            out[k] = (target[s], whole + (k in taken))
    return out


@pytest.mark.parametrize("bins", [4, 1024])
def test_mixing_against_brute_force(spark, bins):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(["a", "a", "a", "b", "c", None, "ü"])) for i in range(700)]
    rows += [(900, None, "a"), (901, "", "b"), (None, "x y", "c"), (None, None, None), (1, rows[1][1], rows[1][2]), (902, "w " * 30000, "a")]
    docs = spark.createDataFrame([(*r, 0, 5, 6, 7) for r in rows], "doc_id long, text string, source string, Taken int, __n int, __u int, __w int")
    mixed = mixing.mix_sources(docs, bins=bins)
    got = mixed.collect()
    want = brute_mix(rows)
    assert Counter((r.doc_id, r.text, r.source, r.target, r.copies) for r in got) == Counter((*row, *w) for row, w in zip(rows, want))
    assert all(r.taken == r.copies * r.size and r.size == len((r.text or "").split()) and (r["__n"], r["__u"], r["__w"]) == (5, 6, 7) for r in got)
    again = mixing.mix_sources(docs.repartition(5)).collect()
    assert Counter((r.doc_id, r.taken) for r in got) == Counter((r.doc_id, r.taken) for r in again)
    assert mixing.expand_copies(mixed).count() == sum(r.copies for r in got)
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_inclusion_rates(spark):
    """Over many seeds, documents are taken as often as their odds say."""
    rng = random.Random(5)
    odds = [rng.choice([0.2, 1.0, 3.0]) for _ in range(600)]
    low, high = 0.0, 100.0
    while high - low > 1e-9:
        c = (low + high) / 2
        low, high = (c, high) if sum(c * g / (1 + c * g) for g in odds) < 240 else (low, c)
    taken, runs = Counter(), 300
    for k in range(runs):
        for i, (_, copies) in enumerate(brute_mix([(i, "w", "s") for i in range(600)], share=0.4, seed=f"{k}:", odds=odds)):
            taken[odds[i]] += copies
    for g in (0.2, 1.0, 3.0):
        assert taken[g] / runs / odds.count(g) == pytest.approx(c * g / (1 + c * g), rel=0.03)
    docs = spark.createDataFrame([(i, "w", "s", g, 0) for i, g in enumerate(odds)], "doc_id long, text string, source string, g double, k int")
    got = {r.doc_id: r.copies for r in mixing.mix_sources(docs, share=0.4, weight_col="g", seed="3:").collect()}
    assert [got[i] for i in range(600)] == [k for _, k in brute_mix([(i, "w", "s") for i in range(600)], share=0.4, seed="3:", odds=odds)]


def test_many_sources(spark):
    docs = spark.range(200_000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), (F.col("id") % 100_003).cast("string").alias("source"))
    row = mixing.mix_sources(docs).agg(F.count(F.lit(1)).alias("n"), F.sum("taken").alias("taken"), F.max("copies").alias("most")).first()
    assert row.n == 200_000 and row.most == 2 and 600_000 < row.taken < 1_000_000


# ---- queries and pipeline ----


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    text = lambda v: "" if v is None else repr(v) if isinstance(v, float) else str(v)
    return sorted(columns), sorted(tuple(text(row[i]) for i in order) for row in rows)


def same(df, cursor):
    assert canonical(df.collect(), df.columns) == canonical(cursor.fetchall(), [c[0] for c in cursor.description])


@needs_tables
@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    same(queries.queries()[name](spark, SF), duck.execute(oracles.oracle_sql()[name]))


@needs_tables
def test_queries_without_sql(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    shards = queries.op5_sharding(spark, SF).toPandas().merge(documents, on="doc_id")
    assert len(shards) == len(documents) and (shards.law == "rows").all()
    assert all(r.size == len(r.text.encode()) + 1 and r.text_crc32 == zlib.crc32(r.text.encode()) for r in shards.itertuples())
    langs = queries.op3_language_id(spark, SF).toPandas().merge(documents, on="doc_id")
    assert (langs.lang == langs.lang_pred)[langs.held_out].mean() > 0.95
    assert queries.op4_license_scan(spark, SF).count() == len(documents)


@needs_tables
def test_pipeline_stages_against_brute_force(spark):
    from test_text_operators import brute_components, brute_hits

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "12 34", "en", "src1", 5), (10**6 + 2, "", "en", None, 0)], docs.schema)
    stage = dict(corpus_pipeline.STAGES)
    columns = docs.columns

    kept = stage["language_id"](spark, docs.unionByName(odd), SF).cache()
    assert kept.columns == columns and sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in docs.collect())

    rows = [(r.doc_id, r.text) for r in kept.collect()]
    roots = brute_components(rows, 5)
    single = stage["near_dedup"](spark, kept, SF).cache()
    assert single.columns == columns and sorted(r.doc_id for r in single.collect()) == sorted(set(roots.values()))

    rows = [(r.doc_id, r.text) for r in single.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert all(len(t.split()) >= 8 for _, t in items)
    clean = stage["decontamination"](spark, single, SF).cache()
    assert clean.columns == columns and sorted(r.doc_id for r in clean.collect()) == sorted(i for i, _, _, n, *_ in brute_hits(rows, items, 8) if not n)

    mixed = stage["mixing"](spark, clean, SF).cache()
    rows = [(r.doc_id, r.text, r.source) for r in clean.collect()]
    words = Counter({r[0]: copies for r, (_, copies) in zip(rows, brute_mix(rows)) if copies})
    assert mixed.columns == columns and Counter(r.doc_id for r in mixed.collect()) == words and set(words.values()) == {1, 2}

    sharded = stage["sharding"](spark, mixed, SF)
    hashed = mixed.select(F.xxhash64(F.lit(7), *columns).alias("h"), "doc_id").collect()
    order = sorted((r.h, r.doc_id) for r in hashed)
    places = np.arange(len(order))
    np.random.default_rng([7, 0]).shuffle(places)  # one bucket at this size
    want = Counter((order[p][1], k % 16, k // 16) for k, p in enumerate(places))
    assert Counter((r.doc_id, r.shard, r.slot) for r in sharded.collect()) == want


def test_near_dedup_stage_on_missing_and_repeated_ids(spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(None, "one two three four five six"), (1, "one two three four five six"), (None, words), (None, f"{words} more"), (7, "a b c d e f"), (7, "a b c d e f"), (7, "g h i j k l"), (None, None)]
    kept = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()
    found = Counter((r.doc_id, r.text and r.text[:3]) for r in kept)
    assert found == Counter({(1, "one"): 1, (None, "w0 "): 1, (7, "a b"): 1, (7, "g h"): 1, (None, None): 1})


def test_language_stage_rejects_what_is_no_language(spark, monkeypatch):
    for lang in (None, "und"):
        rows = [(1, "text", lang), (2, "12 !", lang), (3, None, lang), (4, "= é 7", lang), (5, "", lang)]
        kept = corpus_pipeline.detect_language(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"), SF).collect()
        assert sorted(r.doc_id for r in kept) == [1, 4]
    rows = [(i, t, lang) for i, (t, lang) in enumerate((t, lang) for lang in ("aa", "bb", "cc") for t in texts_of(lang, 60, lang))]
    docs = spark.createDataFrame([*rows, (999, "x", None), (1000, "the thing", None)], "doc_id long, text string, lang string")
    scores = {r.doc_id: r.score for r in language_id.identify(docs).collect()}
    monkeypatch.setattr(corpus_pipeline, "MIN_LANGUAGE_SCORE", 0.7)
    kept = {r.doc_id for r in corpus_pipeline.detect_language(spark, docs, SF).collect()}
    assert scores[999] < 0.7 and kept == set(scores) - {999}


def test_decontamination_stage_and_short_items(spark, tmp_path):
    bench = spark.createDataFrame([(1, "capital of france"), (2, "a b c d e f g h i j")], "item_id long, text string")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(1, "Capital of France?"), (2, "The capital of France is a very large city"), (3, "b c d e f g h i"), (4, "b c d e f g h"), (5, None)]
    kept = corpus_pipeline.drop_benchmark_passages(spark, spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path)).collect()
    assert sorted(r.doc_id for r in kept) == [2, 4, 5]
