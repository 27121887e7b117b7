"""Sharding by a two-pass external shuffle.

Pass one scatters whole records uniformly, by a seeded hash, into as many buckets as
keep each one within a bounded size. Pass two sorts a bucket by hash (so that a rerun
starts from the same order) and shuffles it with Fisher-Yates from a seed of its own.
Buckets laid end to end are one random order of all records; record number i of that
order goes to slot i // shards of shard i % shards, so counts differ by one at most.

Defined cases: null texts and ids are scattered like others; repeated rows are separate
records; rows alike in every column are interchangeable, so their order does not matter,
and share a bucket (rows that differ in any column, such as the id, are spread); a very
long text is one record; an empty table gives no rows. Extra columns travel along, those
of map type too; shard and slot are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import apart, bounded_batches, hashable, measure, partitions, pieces, without

OUTPUTS = ("shard", "slot")


def shard_records(docs: DataFrame, shards: int = 16, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int | None = None) -> DataFrame:
    """docs in one random order, each with its shard (int, from 0) and slot in it (long, gapless from 0)."""
    bounded_batches(docs.sparkSession)
    docs = without(docs, *OUTPUTS)
    rows, size = measure(docs, text_col)
    # Buckets grow from 8 to 128 MB with the corpus, so that there are never many of them.
    buckets = pieces(size + 64 * rows, bucket_bytes or min(128 << 20, max(8 << 20, size >> 14)))
    at_spread, at_bucket = apart(docs, "__spread", "__bucket")
    dealt = docs.withColumn(at_spread, F.xxhash64(F.lit(seed), *hashable(docs)))
    dealt = dealt.withColumn(at_bucket, F.pmod(F.shiftright(F.col(at_spread), 16), F.lit(buckets)).cast("int"))
    # One number for each bucket: where it starts in the whole order.
    counts = np.zeros(buckets + 1, dtype=np.int64)
    for b, n in dealt.groupBy(at_bucket).count().collect():
        counts[b + 1] = n
    starts = np.cumsum(counts)

    def shuffle(bucket: pa.Table) -> pa.Table:
        b = bucket.column(at_bucket)[0].as_py()
        order = pc.sort_indices(bucket, sort_keys=[(at_spread, "ascending")]).to_numpy().copy()
        np.random.default_rng([seed, b]).shuffle(order)
        place = starts[b] + np.arange(len(order), dtype=np.int64)
        out = bucket.take(pa.array(order)).drop_columns([at_spread, at_bucket])
        return out.append_column("shard", pa.array((place % shards).astype(np.int32))).append_column("slot", pa.array(place // shards))

    schema = T.StructType([*docs.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])
    return dealt.repartition(partitions(buckets), at_bucket).groupBy(at_bucket).applyInArrow(shuffle, schema)


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """The sharded records as Parquet, one folder per shard, rows of a file in order of slot."""
    out = shard_records(docs, **options)
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
