"""Joins and flags between posts and replies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import fixed


def with_is_op(replies: DataFrame, posts: DataFrame, check: bool = True) -> DataFrame:
    """replies with is_op: written by the thread's own author. A repeated post_id is an error, as it has no one author.

    With check=False the smallest author of a repeated id counts. Authors are joined as a
    table of one row for each post, so replies never multiply.
    """
    authors = posts.groupBy("post_id").agg(F.min("author").alias("_author"), F.count(F.lit(1)).alias("_n"))
    if check and (double := authors.where("_n > 1 and post_id is not null").select("post_id").first()):
        raise ValueError(f"post_id {double.post_id!r} occurs more than once")
    joined = replies.join(authors.drop("_n"), "post_id", "left")
    return joined.withColumn("is_op", F.coalesce(F.col("author") == F.col("_author"), F.lit(False))).select(*replies.columns, "is_op")


def with_reply_sequence(replies: DataFrame, page: str = "page_no", pos: str = "pos") -> DataFrame:
    """seq and reply_id: replies of a thread numbered from 1, page by page in document order."""
    order = Window.partitionBy("post_id").orderBy(page, pos)
    numbered = replies.withColumn("seq", F.row_number().over(order))
    return numbered.withColumn("reply_id", F.concat_ws("#", "post_id", "seq"))


def is_short(word_count: str = "word_count", least: int = fixed.SHORT_POST_WORDS):
    return F.col(word_count) < least


def is_incomplete(scraped: str = "replies_scraped", reported: str = "replies_reported"):
    return F.col(scraped) < F.col(reported)


def research_subsets(replies: DataFrame, since_year: int = 2017) -> dict[str, DataFrame]:
    """The usual cuts of the clean replies."""
    by_members = replies.where(~F.col("is_staff"))
    return {
        "non_staff": by_members,
        "non_staff_non_op": by_members.where(~F.col("is_op")),
        "recent": replies.where(F.year(F.try_to_timestamp("publish_time_iso")) >= since_year),
    }
