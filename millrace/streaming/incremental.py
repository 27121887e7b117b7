"""Incremental runs as streams: what is new since the last run, once each, then stop.

The stream's own checkpoint remembers which files it has read; a left anti join on the
sink keeps one record for each key, whenever it comes. A full refresh is a new pair of
folders. Late replies to known threads are left out, as a thread is read once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..sources.tables import file_facts, first_by


def append_new(spark: SparkSession, sink: str, key: str, order: list[str], after: Callable[[DataFrame], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: the first row of each key that the sink doesn't hold is appended to it."""

    def run(batch: DataFrame, _: int) -> None:
        new = first_by(batch, [key], order).withColumn("_key", F.col(key))
        if not file_facts(batch.sparkSession, sink).isEmpty():
            old = batch.sparkSession.read.schema(batch.schema).parquet(sink).select(F.col(key).alias("_key"))
            new = new.join(old, "_key", "left_anti")
        new = new.drop("_key")
        if new.isEmpty():
            return  # nothing new: nothing is cleaned or written
        new.write.mode("append").parquet(sink)
        if after:
            after(new)

    return run


def run_available(source: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str) -> int:
    """Process what is there and stop; the number of rows read."""
    query = source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(p.numInputRows for p in query.recentProgress)


def ingest_threads(spark: SparkSession, folder: str, sink: str, checkpoint: str, after: Callable[[DataFrame], None] | None = None) -> int:
    """New thread records (JSON lines in folder) into the Parquet sink, one for each post URL."""
    source = spark.readStream.schema(schemas.checkpoint_fields()).option("mode", "DROPMALFORMED").json(folder)
    keyed = source.where("post is not null").select(F.col("post.url").alias("url"), "post", "replies")
    return run_available(keyed, append_new(spark, sink, "url", ["url"], after), checkpoint)
