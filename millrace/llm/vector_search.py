"""Approximate nearest neighbours by cosine: inverted lists with an adaptive dimension scan.

Index. Centroids are fitted on a sample of the vectors of smallest hash: at most
max(train_rows, 8 * lists) of them, the documented bound. There are about sqrt(n) / 2
lists, up to 65,536; every vector is then assigned to the list of its nearest centroid. A
list is cut into blocks of at most block_rows vectors, and the queries of a list into
blocks too, so no task grows with a list.

Search. A query scans its nearest lists: as large a share of all lists as, within the
sample, held `recall` of the true neighbours of sample queries (measured by brute force
there), and more until these hold enough candidates. So data without clear clusters get
more probes. The nearest list of each query is scanned first; the k-th best found there
is the bound that the query carries to all its other lists, from which only better
candidates leave. Vectors are scaled to length one and turned by a random rotation, so
that any few coordinates estimate the whole distance. A list block is read in column
blocks, for all queries of a block at once: after each, a hypothesis test compares the
partial distance, scaled up, with the k-th best so far, and candidates that are almost
surely further are abandoned. Survivors are scored exactly, in double precision on the
original vectors (scaled by a power of two, which changes no digit, so that neither very
large nor very small components overflow or vanish).

Identical vectors of an Arrow batch are combined before anything is shuffled: only the
k + 1 smallest ids of each can be among any query's k nearest, since ties go to the
smaller id. That loses nothing and disarms one vector that fills a third of a table.

Defined cases: vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part, as queries or candidates; null ids take no part; an
id repeated with other vectors counts once, with the best score of any of its vectors;
ids have to be whole numbers or text of such; empty tables give no rows. Only the two
named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise, pieces


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # against overflow and underflow
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by the power of two next to their largest component."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=-1, keepdims=True))[1])


def cosines(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosines of rows in double precision, each sum taken coordinate by coordinate, so equal vectors score equally."""
    x, q = _scaled(x), _scaled(q)
    total = lambda products: np.cumsum(products, axis=1)[:, -1]
    return total(x * q) / (np.sqrt(total(x * x)) * np.sqrt(total(q * q)))


def fit_centroids(sample: np.ndarray, lists: int, seed: int, rounds: int = 10) -> np.ndarray:
    rng = np.random.default_rng(seed)
    x = np.unique(_unit(sample), axis=0)
    centres = x[rng.permutation(len(x))[: min(lists, len(x))]]
    for _ in range(rounds):
        near = np.concatenate([(part @ centres.T).argmax(axis=1) for part in np.array_split(x, 1 + len(x) // 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        full = np.abs(sums).max(axis=1) > 0
        centres[full] = _unit(sums[full])
    return centres


def probe_share(sample: np.ndarray, centres: np.ndarray, k: int, recall: float, seed: int, queries: int = 256) -> float:
    """The share of lists, nearest first, that holds `recall` of the k nearest of sample queries within the sample."""
    x = np.unique(_unit(sample), axis=0)
    if len(x) <= k + 1:
        return 1.0
    q = x[np.random.default_rng(seed).permutation(len(x))[:queries]]
    near = np.concatenate([(part @ centres.T).argmax(axis=1) for part in np.array_split(x, 1 + len(x) // 4096)])
    best = np.argpartition(-(q @ x.T), k + 1, axis=1)[:, : k + 1]  # the query itself is among them
    order = np.argsort(-(q @ centres.T), axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(order.shape[1])[None, :], axis=1)
    needed = np.sort(np.take_along_axis(place, near[best], axis=1), axis=None)[len(q) :]
    return float((needed[min(len(needed) - 1, int(math.ceil(recall * len(needed))))] + 1) / len(centres))


def _smallest_of_equals(ids: np.ndarray, x: np.ndarray, keep: int) -> np.ndarray:
    """Rows to keep: for each distinct vector those of its smallest distinct ids."""
    _, group = np.unique(np.ascontiguousarray(x).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel(), return_inverse=True)
    order = np.lexsort((ids, group))
    g, i = group[order], ids[order]
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (g[1:] != g[:-1]) | (i[1:] != i[:-1])
    order, g = order[fresh], g[fresh]
    begin = np.flatnonzero(np.diff(g, prepend=-1))
    place = np.arange(len(g)) - np.repeat(begin, np.diff(np.append(begin, len(g))))
    return np.sort(order[place < keep])


def adaptive_scan(
    x: np.ndarray, ids: np.ndarray, original: np.ndarray, q: np.ndarray, q_ids: np.ndarray, q_original: np.ndarray, bounds: np.ndarray, k: int, columns: int = 16, epsilon: float = 2.1
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query rows, ids, scores): the best k of one block for each query, none further than its bound.

    x and q are unit vectors, rotated; bounds are squared distances.
    """
    width, n = x.shape[1], len(x)
    head, q_head = x[:, :columns], q[:, :columns]
    part = (head * head).sum(axis=1)[None, :] + (q_head * q_head).sum(axis=1)[:, None] - 2 * (q_head @ head.T)
    part[q_ids[:, None] == ids[None, :]] = np.inf
    bound = bounds.copy()
    if n > 4 * k:
        # The candidates that look nearest: their true distances bound the k-th best.
        first = np.argpartition(part, 4 * k, axis=1)[:, : 4 * k]
        near = ((x[first] - q[:, None, :]) ** 2).sum(axis=2)
        near[np.take_along_axis(part, first, axis=1) == np.inf] = np.inf
        bound = np.minimum(bound, np.sort(near, axis=1)[:, k - 1])
    scale = width / min(columns, width)
    row, at = np.nonzero(part * scale <= (bound * (1 + epsilon / math.sqrt(columns)) ** 2 + 1e-9)[:, None])
    part = part[row, at]
    row, at, part = row[part < np.inf], at[part < np.inf], part[part < np.inf]
    for d in range(columns, width, columns):
        part = part + ((x[at, d : d + columns] - q[row, d : d + columns]) ** 2).sum(axis=1)
        seen = min(d + columns, width)
        ok = part * (width / seen) <= bound[row] * (1 + (epsilon / math.sqrt(seen) if seen < width else 0.0)) ** 2 + 1e-9
        row, at, part = row[ok], at[ok], part[ok]
    scores = cosines(original[at], q_original[row])
    order = np.lexsort((ids[at], -scores, row))
    row, at, scores = row[order], at[order], scores[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], ids[at][place < k], scores[place < k]


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    lists: int | None = None,
    recall: float = 0.97,
    train_rows: int = 20_000,
    block_rows: int = 8192,
    query_rows: int = 1024,
    seed: int = 11,
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row where is_query, its k nearest other rows."""
    spark = vectors.sparkSession
    every = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"), is_query.alias("q"))
    rows = every.where(F.col("id").isNotNull() & usable(F.col("v")))
    sizes = sorted(((r["n"], r["w"]) for r in rows.groupBy(F.size("v").alias("w")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    n, width = sizes[0] if sizes else (0, 1)
    rows = rows.where(F.size("v") == width)
    lists = lists or min(65_536, max(1, round(math.sqrt(n) / 2)))
    sample = rows.orderBy(F.xxhash64(F.lit(seed), "id", "v"), "id", "v").limit(max(train_rows, 8 * lists)).select("v").collect()
    sample = np.array([r.v for r in sample], dtype=np.float64).reshape(-1, width)
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    centres = fit_centroids(sample, lists, seed)
    probes = math.ceil(probe_share(sample, centres, k, recall, seed) * len(centres))
    turn = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, width)))[0]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), width)
            stay = _smallest_of_equals(batch.column(0).to_numpy(), x, k + 1)
            near = (_unit(x[stay]) @ centres.T).argmax(axis=1).astype(np.int32)
            kept = batch.take(pa.array(stay))
            yield pa.RecordBatch.from_arrays([pa.array(near), kept.column(0), kept.column(1)], names=["list", "id", "v"])

    index = materialise(rows.select("id", "v").mapInArrow(assign, "list int, id long, v array<double>"), "ivf")
    filled = dict(index.groupBy("list").count().collect())  # one number for each list
    held = np.array([filled.get(i, 0) for i in range(len(centres))])
    blocks = np.array([pieces(int(c), block_rows) for c in held])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            order = np.argsort(-(_unit(_matrix(batch.column(1), width)) @ centres.T), axis=1, kind="stable")
            enough = np.cumsum(held[order], axis=1) - held[order] < 4 * (k + 1)
            use = enough | (np.arange(order.shape[1]) < probes)
            row, at = np.nonzero(use)
            near = order[row, at]
            row, near = row[held[near] > 0], near[held[near] > 0]
            first = np.diff(row, prepend=-1) > 0  # the nearest list of each query
            times = blocks[near]
            block = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            row, near, first = np.repeat(row, times), np.repeat(near, times), np.repeat(first, times)
            sent = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([pa.array(near.astype(np.int32)), pa.array(block.astype(np.int32)), *sent.columns, pa.array(first)], names=["list", "block", "id", "v", "bound", "first"])

    asked = rows.where("q").select("id", "v").dropDuplicates(["id", "v"])
    spread = lambda tag, over: F.pmod(F.xxhash64(F.lit(tag), "id"), F.col(over)).cast("int")

    def scan(asked: pa.Table, found: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]]
        if asked.num_rows and found.num_rows:
            ids, original = found.column("id").to_numpy(), _matrix(found.column("v"), width)
            stay = _smallest_of_equals(ids, original, k + 1)
            ids, original = ids[stay], original[stay]
            x = _unit(original) @ turn
            wanted, q_ids, bounds = _matrix(asked.column("v"), width), asked.column("id").to_numpy(), asked.column("bound").to_numpy()
            q = _unit(wanted) @ turn
            step = max(1, (1 << 21) // len(ids))  # so that a matrix of partial distances stays small
            for a in range(0, len(q), step):
                part = slice(a, a + step)
                row, near, score = adaptive_scan(x, ids, original, q[part], q_ids[part], wanted[part], bounds[part], k)
                for column, values in zip(out, (q_ids[part][row], near, score)):
                    column.append(values)
        return pa.table({name: np.concatenate(v) for name, v in zip(("query_id", "vec_id", "score"), out)})

    def scanned(queries: DataFrame) -> DataFrame:
        """The best of each list block for its queries. Queries of one list come in blocks as well; a list block goes to each of them."""
        per_list = {r["list"]: r["n"] for r in queries.where("block = 0").groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
        shape = spark.createDataFrame([(i, int(blocks[i]), pieces(per_list.get(i, 0), query_rows)) for i in range(len(centres)) if per_list.get(i)], "list int, blocks int, query_blocks int")
        left = queries.join(F.broadcast(shape), "list").withColumn("query_block", spread("q", "query_blocks")).select("list", "block", "query_block", "id", "v", "bound")
        right = (
            index.join(F.broadcast(shape), "list")
            .withColumns({"block": spread("v", "blocks"), "query_block": F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1))})
            .select("list", "block", "query_block", "id", "v")
        )
        keys = ("list", "block", "query_block")
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(scan, "query_id long, vec_id long, score double")

    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def best(found: DataFrame) -> DataFrame:
        once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return once.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)

    probes_of = lambda df: df.mapInArrow(probe, "list int, block int, id long, v array<double>, bound double, first boolean")
    begun = materialise(best(scanned(probes_of(asked.withColumn("bound", F.lit(float("inf")))).where("first"))), "begun")
    # Twice one less the cosine is the squared distance; a hair more, against rounding.
    worst = begun.where(F.col("rank") == k).select(F.col("query_id").alias("id"), (2 - 2 * F.col("score") + 1e-9).alias("bound"))
    bounded = asked.join(worst, "id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    rest = scanned(probes_of(bounded).where("NOT first"))
    return best(rest.unionByName(begun.select("query_id", "vec_id", "score"))).select("query_id", "rank", "vec_id", "score")
