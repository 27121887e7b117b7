"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of whole texts for each language. It reads a hash sample of about
max_rows_per_language labelled rows (the documented bound; priors count all labelled
rows). The model is a matrix of log-probabilities, features x languages, of at most
max_cells numbers, and is broadcast: up to 256 languages it has all `features` hash
buckets, with more languages fewer buckets (never fewer than 1,024), so any number of
labels can be learned. Counts come to the driver as one packed row a language. Prediction gathers the rows of the
n-grams that a text has and sums them by text, in numpy, in pieces of bounded length
however long a text is. Only the text decides.

Defined cases: a null text or one without a letter is "und" with score 0, as is every
text when there is nothing to learn from; ties go to the smallest label by code point;
rows without label aren't learned from; very long texts are read in pieces; repeated rows are judged alike. Extra columns are
carried; columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, without
from .words import U64, mix

OUTPUTS = ("lang_pred", "score")
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_PIECE = 1 << 19


def _pieces(texts: list[str], longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(code points, where each piece begins, its text): pieces overlap so that every n-gram begins in exactly one."""
    held, owners, size = [], [], 0
    for i, text in enumerate(texts):
        low = f" {text.lower()} "
        for at in range(0, len(low), _PIECE):
            piece = low[at : at + _PIECE + longest - 1]
            held.append(piece)
            owners.append(i)
            size += len(piece)
            if size >= _PIECE:
                yield _points(held, owners)
                held, owners, size = [], [], 0
    if held:
        yield _points(held, owners)


def _points(held: list[str], owners: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    points = np.frombuffer("".join(held).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    starts = np.concatenate(([0], np.cumsum([len(x) for x in held])[:-1]))
    return points, starts, np.array(owners)


def _features(points: np.ndarray, starts: np.ndarray, orders: tuple[int, ...], features: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: hashed n-grams, and the piece that each begins in; those over a piece's end are left out."""
    ends = np.append(starts[1:], len(points))
    owner = np.repeat(np.arange(len(starts)), ends - starts)
    wide = points.astype(U64)
    for k in orders:
        n = len(points) - k + 1
        if n <= 0:
            continue
        h = np.full(n, U64(k))
        for j in range(k):
            h = h * U64(0x9E3779B97F4A7C15) + wide[j : j + n]
        # n-grams of shorter orders must not begin in the overlap, which the next piece has too.
        own = owner[:n]
        inside = (np.arange(n) + k <= ends[own]) & (np.arange(n) - starts[own] < _PIECE)
        yield (mix(h) % U64(features)).astype(np.int64)[inside], own[inside]


def train(labelled: DataFrame, orders: tuple[int, ...] = (2, 3), features: int = 1 << 16, max_rows_per_language: int = 4000, max_cells: int = 1 << 24, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", alpha: float = 0.1) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log priors, log-probabilities as features x languages)."""
    bounded_batches(labelled.sparkSession)
    rows = labelled.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t"), F.col(f"`{lang_col}`").alias("l")).where("l is not null and t is not null")
    totals = dict(rows.groupBy("l").count().collect())
    if not totals:
        return [], np.zeros(0), np.zeros((features, 0), np.float32)
    while features > 1024 and features * len(totals) > max_cells:
        features //= 2
    draw = F.pmod(F.xxhash64(F.lit("train"), "i", "t"), F.lit(1_000_003)) / 1_000_003  # ids can be missing or repeated
    shares = rows.sparkSession.createDataFrame([(k, min(1.0, max_rows_per_language / n)) for k, n in totals.items()], "l string, share double")
    sample = rows.join(F.broadcast(shares), "l").where(draw < F.col("share")).select("l", "t")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(langs, batch.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                own = total.setdefault(lang, np.zeros(features, np.int64))
                for points, starts, _ in _pieces(texts, max(orders)):
                    for h, _ in _features(points, starts, orders, features):
                        own += np.bincount(h, minlength=features)
        for lang, own in total.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(own[at])], names=["l", "f", "n"])

    langs = sorted(totals)
    place = {x: i for i, x in enumerate(langs)}
    counts = np.zeros((features, len(langs)))
    for lang, packed in _packed(sample.mapInArrow(count, "l string, f int, n long"), features).toLocalIterator():
        counts[:, place[lang]] = np.frombuffer(packed, dtype=np.int64)
    prob = (counts + alpha) / (counts.sum(axis=0) + alpha * features)
    prior = np.log(np.array([totals[x] for x in langs], float) / sum(totals.values()))
    return langs, prior, np.log(prob).astype(np.float32)


def _packed(counted: DataFrame, features: int) -> DataFrame:
    """One row a language: its counts of all features as bytes. A group has at most `features` rows."""

    def pack(rows: pa.Table) -> pa.Table:
        own = np.zeros(features, np.int64)
        own[rows.column("f").to_numpy()] = rows.column("n").to_numpy()
        return pa.table({"l": rows.column("l")[:1], "packed": pa.array([own.tobytes()], pa.binary())})

    return counted.groupBy("l", "f").agg(F.sum("n").alias("n")).groupBy("l").applyInArrow(pack, "l string, packed binary")


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], orders: tuple[int, ...] = (2, 3), text_col: str = "text") -> DataFrame:
    """docs with lang_pred and score, the posterior probability of the language."""
    bounded_batches(docs.sparkSession)
    docs = without(docs, *OUTPUTS)
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, prior, table = held.value
        columns = np.ascontiguousarray(table.T.astype(np.float64))
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            known = np.array([bool(langs) and _LETTER.search(t) is not None for t in texts], dtype=bool)
            total = np.tile(prior, (len(texts), 1))
            for points, starts, owners in _pieces(texts, max(orders)):
                for h, piece in _features(points, starts, orders, len(table)):
                    if not len(h):
                        continue
                    cuts = np.flatnonzero(np.diff(piece, prepend=-1))
                    for j, column in enumerate(columns):
                        np.add.at(total[:, j], owners[piece[cuts]], np.add.reduceat(column[h], cuts))
            if langs:
                best = total.argmax(axis=1)
                score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                names = [langs[b] if k else UNKNOWN for b, k in zip(best, known)]
                score = np.where(known, score, 0.0)
            else:
                names, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(score, pa.float64())], names=schema.names)

    return docs.mapInArrow(label, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))) % 4 == 2


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """docs with held_out, lang_pred and score, learned from the labelled rows that aren't held out."""
    docs = without(docs, "held_out")
    model = train(docs.where(~held_out(id_col)), id_col=id_col, text_col=text_col, lang_col=lang_col, **options)
    return predict(docs.withColumn("held_out", held_out(id_col)), model, text_col=text_col)
