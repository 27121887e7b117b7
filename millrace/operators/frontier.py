"""What to fetch next: new discussion URLs, newest first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_entries(entries: DataFrame, seen: DataFrame, order: tuple[str, ...] = ("shard_file", "pos")) -> DataFrame:
    """Sitemap entries whose URL isn't in seen (url), one for each URL: the first by lastmod, then by order."""
    row = F.struct(*[F.col(f"`{c}`") for c in entries.columns])
    first = entries.groupBy("loc", F.coalesce("lastmod", F.lit("")).alias("at")).agg(F.min_by(row, F.struct(*order)).alias("e"))
    newest = first.groupBy("loc").agg(F.max_by("e", "at").alias("e")).select("e.*")
    return newest.join(seen.select(F.col("url").alias("loc")).distinct(), "loc", "left_anti").select(*entries.columns)


def newest_first(entries: DataFrame, order: tuple[str, ...] = ("shard_file", "pos")) -> DataFrame:
    """By lastmod as text, descending; ties stay in shard and document order, missing dates come last."""
    return entries.orderBy(F.desc("lastmod"), *order)


def remaining(target: int | None, have: int) -> int | None:
    """How many more threads a cumulative target leaves; None is no limit."""
    return max(0, target - have) if target else None
