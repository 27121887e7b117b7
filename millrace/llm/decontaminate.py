"""Benchmark decontamination with suffix arrays of the training text.

Training documents are cut into shards (the Arrow batches of the scan; documents are
never split). A shard's suffix array holds the suffixes that can begin a match at all:
those whose first words (up to three) begin some test window; no other suffix can be
found. Every distinct test suffix is binary-searched in it, word by word, which narrows
to the range of training suffixes that share its window: these are the locations. A match
is extended for as long as the test item and the document go on alike; matches of one
item along one diagonal (document place less item place) are consecutive windows of one
longer match, so runs along diagonals are the longest verbatim matches, with their places
in the item and in the document.

Words are compared by 64-bit hashes. The test set is read on the driver in blocks of at
most block_bytes (one longer item is a block of its own). A block is kept as sorted
arrays, about five times its bytes, and is broadcast; a larger test set takes several
passes over the training text, whose hits are merged by row. So nothing is left out, and
a broadcast or a worker's tables never outgrow a few times block_bytes.

Defined cases: a null text has no words and is never contaminated; an item without words
or without id matches nothing; items with equal texts all count; rows that repeat an item
id are one item; repeated document rows are judged alike; very long texts are searched
whole; empty tables give no rows or no hits. Extra columns are carried, whatever their
names or types; columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import apart, bounded_batches, materialise, without
from .words import ALNUM, U64, Words, cover, mix, spans, windows

OUTPUTS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest_match", "spans", "matches", "items")
_SPAN = pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64())]))
_MATCH = pa.list_(pa.struct([("item", pa.string()), ("item_word", pa.int64()), ("first_word", pa.int64()), ("words", pa.int64())]))
_FIELDS = "n_words long, spans array<struct<first_word:long,end_word:long>>, matches array<struct<item:string,item_word:long,first_word:long,words:long>>"
_MOST_PAIRS = 1 << 21


class TestSet:
    """The suffixes of one block of items, as arrays over all its words."""

    __test__ = False

    def __init__(self, ids: list[str], texts: pa.Array, window: int):
        words = Words(texts, ALNUM, lower=True)
        self.ids, self.first, self.hashes = ids, words.first, words.hashes
        width = np.minimum(window, np.repeat(words.counts, words.counts))
        place = np.arange(len(words))
        # By width: distinct windows (where one of each begins), and all places of each.
        self.kinds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for w in np.unique(width).tolist():
            at = place[(width == w) & (place + w <= words.stop)]
            _, one, number = np.unique(windows(self.hashes, w)[at], return_index=True, return_inverse=True)
            order = np.argsort(number, kind="stable")
            begin = np.concatenate(([0], np.cumsum(np.bincount(number))))
            heads = np.unique(_head(self.hashes, at[one], min(3, w)))
            self.kinds[w] = (at[one], at[order], begin, heads)


def _head(h: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k words from each place on."""
    out = np.zeros(len(at), dtype=U64)
    for j in range(k):
        out = mix(out * U64(3) + h[at + j])
    return out


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are known; a bit table over their low bits spares most searches."""
    size = 1 << max(16, int(len(known)).bit_length() + 6)
    seen = np.zeros(size, dtype=bool)
    seen[known & U64(size - 1)] = True
    at = np.flatnonzero(seen[values & U64(size - 1)])
    place = np.searchsorted(known, values[at])
    at = at[(place < len(known)) & (known[np.minimum(place, len(known) - 1)] == values[at])]
    return at


def suffix_array(h: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes beginning at the given places, sorted by their first depth words."""
    return at[np.lexsort([h[at + d] for d in range(depth - 1, -1, -1)])]


def search(h: np.ndarray, suffixes: np.ndarray, test: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each test suffix, the range of sorted suffixes that begin with its first depth words."""
    lo, hi = np.zeros(len(at), np.int64), np.full(len(at), len(suffixes), np.int64)
    for d in range(depth):
        column, value = h[suffixes + d], test[at + d]
        lo, hi = _bound(column, value, lo, hi, False), _bound(column, value, lo, hi, True)
    return lo, hi


def _bound(column: np.ndarray, value: np.ndarray, lo: np.ndarray, hi: np.ndarray, after: bool) -> np.ndarray:
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        seen = column[np.minimum(mid, len(column) - 1)]
        right = open_ & ((seen <= value) if after else (seen < value))
        lo = np.where(right, mid + 1, lo)
        hi = np.where(open_ & ~right, mid, hi)
    return lo


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of these ranges, and the range that each belongs to."""
    n = hi - lo
    owner = np.repeat(np.arange(len(n)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + lo[owner], owner


def longest_matches(places: np.ndarray, tests: np.ndarray, doc: np.ndarray, item: np.ndarray, width: int) -> np.ndarray:
    """Of windows at (training place, test place) with their document and item: rows of the longest match of each
    document and item (document, item, test place, training place, words); the first place where several are as long."""
    order = np.lexsort((places, places - tests, item, doc))
    p, t, d, i = places[order], tests[order], doc[order], item[order]
    fresh = np.ones(len(p), dtype=bool)
    fresh[1:] = (d[1:] != d[:-1]) | (i[1:] != i[:-1]) | (p[1:] - t[1:] != p[:-1] - t[:-1]) | (p[1:] != p[:-1] + 1)
    begin = np.flatnonzero(fresh)
    words = np.diff(np.append(begin, len(p))) + width - 1
    best = np.lexsort((t[begin], p[begin], -words, i[begin], d[begin]))
    d, i = d[begin][best], i[begin][best]
    keep = best[np.concatenate(([True], (d[1:] != d[:-1]) | (i[1:] != i[:-1])))] if len(best) else best
    at = begin[keep]
    return np.stack((doc[order][at], item[order][at], t[at], p[at], words[keep]), axis=1)


def _scan(words: Words, tests: TestSet) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which words lie in an occurrence of a test window, and the longest matches of each text and item."""
    n, h = len(words), words.hashes
    hit, found = np.zeros(n, dtype=bool), []
    for width, (one, places, begin, heads) in tests.kinds.items():
        at = np.flatnonzero(np.arange(n) + width <= words.stop)
        at = at[_among(_head(h, at, min(3, width)), heads)] if len(at) else at
        if not len(at):
            continue
        suffixes = suffix_array(h, at, width)
        lo, hi = search(h, suffixes, tests.hashes, one, width)
        where, window = _ranges(lo, hi)
        where = suffixes[where]
        hit |= cover(where, width, n)
        # Each place meets every test place of its window; in portions of texts, and of items where a text has too many.
        pairs = begin[window + 1] - begin[window]
        text = np.searchsorted(words.first, where, side="right") - 1
        order = np.argsort(text, kind="stable")
        where, window, text, pairs = where[order], window[order], text[order], pairs[order]
        ends = np.cumsum(pairs)
        cuts = np.flatnonzero(np.diff(text)) + 1
        stops, last = [], 0
        for cut in [*cuts.tolist(), len(where)]:
            if cut and ends[cut - 1] - (ends[last - 1] if last else 0) > _MOST_PAIRS and cut != last:
                stops.append(cut)
                last = cut
        for a, b in zip([0, *stops], [*stops, len(where)]):
            if a == b:
                continue
            total = int(pairs[a:b].sum())
            items = np.linspace(0, len(tests.ids), 1 + -(-total // (4 * _MOST_PAIRS)), dtype=np.int64)
            for x, y in zip(items, items[1:]):
                lo, hi = begin[window[a:b]], begin[window[a:b] + 1]
                if len(items) > 2:  # places of a window are in order, so those of some items are a range
                    lo, hi = _within(places, lo, hi, tests.first[x], tests.first[y])
                spot, owner = _ranges(lo, hi)
                spot = places[spot]
                item = np.searchsorted(tests.first, spot, side="right") - 1
                found.append(longest_matches(where[a:b][owner], spot, text[a:b][owner], item, width))
    return hit, found


def _within(places: np.ndarray, lo: np.ndarray, hi: np.ndarray, first: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The parts of these ranges of sorted places that lie from first to end."""
    low = _bound(places, np.full(len(lo), first), lo, hi, False)
    return low, _bound(places, np.full(len(lo), end), low, hi, False)


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[tuple[list[str], list[str]]]:
    """The items in blocks of bounded bytes; toLocalIterator holds one partition at a time on the driver."""
    ids, texts, size = [], [], 0
    rows = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("i"), F.col(f"`{text_col}`").alias("t")).where("i is not null and t is not null")
    for r in rows.toLocalIterator():
        own = len(r.t.encode("utf-8", "surrogatepass"))
        if ids and size + own > block_bytes:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(r.i)
        texts.append(r.t)
        size += own
    yield ids, texts


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 8,
    min_items: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = 8 << 20,
) -> DataFrame:
    """docs with n_words, n_hit, n_items, items_sha256, contaminated, longest_match (in words), spans (words that are
    hit), matches (the longest of each item, with its places in item and document) and items."""
    bounded_batches(docs.sparkSession)
    docs = without(docs, *OUTPUTS)

    def scanner(source: DataFrame, block, every: bool):
        """Adds _FIELDS to the rows of source; rows without a hit are left out unless every row is asked for."""
        at_text = source.columns.index(text_col)
        schema = T.StructType([*source.schema.fields, *T._parse_datatype_string(_FIELDS).fields])
        held = docs.sparkSession.sparkContext.broadcast(TestSet(block[0], pa.array(block[1], pa.large_string()), window))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tests = held.value
            for batch in batches:
                for part in _portions(batch, at_text):
                    words = Words(part.column(at_text), ALNUM, lower=True)
                    hit, found = _scan(words, tests)
                    runs: list[list] = [[] for _ in range(words.n)]
                    matches: list[dict] = [{} for _ in range(words.n)]
                    for i in np.unique(np.searchsorted(words.first, np.flatnonzero(hit), side="right") - 1).tolist():
                        runs[i] = [{"first_word": a, "end_word": b} for a, b in zip(*(x.tolist() for x in spans(hit[words.first[i] : words.first[i + 1]])))]
                    for doc, item, there, here, n in (row for rows in found for row in rows.tolist()):
                        own = (-n, here - int(words.first[doc]), there - int(tests.first[item]))
                        name = tests.ids[item]
                        matches[doc][name] = min(own, matches[doc].get(name, own))
                    told = [[{"item": k, "item_word": m[2], "first_word": m[1], "words": -m[0]} for k, m in sorted(x.items())] for x in matches]
                    columns = [*part.columns, pa.array(words.counts, pa.int64()), pa.array(runs, _SPAN), pa.array(told, _MATCH)]
                    out = pa.RecordBatch.from_arrays(columns, names=schema.names)
                    yield out if every else out.filter(pa.array([bool(r) for r in runs], pa.bool_()))

        return source.mapInArrow(scan, schema)

    blocks = _blocks(benchmark, item_col, item_text_col, block_bytes)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        found = scanner(docs, first, every=True)
    else:
        row = apart(docs, "__row")[0]
        # Rows are numbered once and for all, so that hits of several passes find their row.
        docs_rows = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
        asked = docs_rows.select(row, F.col(f"`{text_col}`"))
        passes = [scanner(asked, b, every=i == 0).drop(text_col) for i, b in enumerate((first, second, *blocks))]
        found = docs_rows.join(_merged(passes, row), row).drop(row)
    words_of = lambda x: x["words"]
    items = F.transform("matches", lambda m: m["item"])
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end_word"] - x["first_word"])
    return found.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        "n_words",
        n_hit.alias("n_hit"),
        F.size("matches").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.size("matches") >= min_items).alias("contaminated"),
        F.coalesce(F.array_max(F.transform("matches", words_of)), F.lit(0)).cast("long").alias("longest_match"),
        "spans",
        "matches",
        items.alias("items"),
    )


def _portions(batch: pa.RecordBatch, texts: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about 4 MB of text, so that a shard's arrays stay small."""
    if not batch.num_rows:
        return
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(texts)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = [0, *np.flatnonzero(np.diff(size // most)) + 1, batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def _merged(passes: list[DataFrame], row: str) -> DataFrame:
    """One result a row of what several passes found; only rows with hits come twice."""
    union = reduce(DataFrame.unionByName, passes)
    flat = lambda c: F.array_sort(F.flatten(F.collect_list(c)))
    one = union.groupBy(row).agg(F.max("n_words").alias("n_words"), flat("spans").alias("s"), flat("matches").alias("m"))
    span = "struct<first_word:long,end_word:long>"
    start = F.struct(F.array().cast(f"array<{span}>").alias("done"), F.lit(None).cast(span).alias("open"))

    def step(acc, x):
        joins = x["first_word"] <= acc["open"]["end_word"]
        grown = F.struct(acc["open"]["first_word"].alias("first_word"), F.greatest(acc["open"]["end_word"], x["end_word"]).alias("end_word"))
        closed = F.when(acc["open"].isNull(), acc["done"]).otherwise(F.array_append(acc["done"], acc["open"]))
        return F.struct(F.when(joins, acc["done"]).otherwise(closed).alias("done"), F.when(joins, grown).otherwise(x).alias("open"))

    end = lambda acc: F.when(acc["open"].isNull(), acc["done"]).otherwise(F.array_append(acc["done"], acc["open"]))

    # An id whose rows came in several blocks has several matches: the longest stays.
    match = "struct<item:string,item_word:long,first_word:long,words:long>"
    kept = F.struct(F.array().cast(f"array<{match}>").alias("done"), F.lit(None).cast(match).alias("open"))

    def longer(acc, x):
        alike = x["item"] == acc["open"]["item"]
        closed = F.when(acc["open"].isNull(), acc["done"]).otherwise(F.array_append(acc["done"], acc["open"]))
        best = F.when(x["words"] > acc["open"]["words"], x).otherwise(acc["open"])
        return F.struct(F.when(alike, acc["done"]).otherwise(closed).alias("done"), F.when(alike, best).otherwise(x).alias("open"))

    return one.select(row, "n_words", F.aggregate("s", start, step, end).alias("spans"), F.aggregate("m", kept, longer, end).alias("matches"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """docs without the contaminated ones, with the columns of docs."""
    return find_contamination(docs, benchmark, **options).where("NOT contaminated").select(*[F.col(f"`{c}`") for c in docs.columns])
