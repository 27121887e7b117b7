"""From pages to the checkpoint: parse, filter, follow reply pages, append.

crawl() fetches all threads of a frontier page by page: every round fetches the next page
of the threads that still go on. assemble_threads() does the same over pages that are
already there, with one window instead of rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import fixed, schemas
from ..fixed import SiteProfile
from ..functions import extract as E
from ..functions.html import page_parser
from ..functions.text import strip, word_count
from ..operators.enrich import with_reply_sequence
from ..operators.frontier import new_entries, newest_first, remaining
from ..operators.relevance import with_relevance
from ..sources.fetch import Fetcher, fetch_pages
from ..sources.scratch import written
from ..sources.tables import append_checkpoint, read_checkpoint

OUTCOMES = ("kept", "failed", "skipped_irrelevant")


def parse_pages(pages: DataFrame, site: SiteProfile) -> DataFrame:
    """(url, page_no, page) with the parsed page; null for a page that isn't there."""
    return pages.select("url", "page_no", page_parser(site)("html", "url").alias("page"))


def posts_of(first_pages: DataFrame, site: SiteProfile, mode: str = "terms") -> DataFrame:
    """Posts of parsed first pages (url, lastmod, page) with outcome, in raw columns as far as page one tells."""
    p = F.col("page.post")
    text = strip(F.coalesce(p["content"], F.lit("")))
    posts = first_pages.select(
        E.last_segment(F.col("url")).alias("post_id"),
        "url",
        p["title"].alias("title"),
        p["topic"].alias("topic"),
        F.when(p["topic_href"] == "", F.lit("")).otherwise(E.last_segment(p["topic_href"])).alias("topic_slug"),
        E.author_name(p["author_raw"]).alias("author"),
        E.author_inactive(p["author_raw"]).alias("author_inactive"),
        E.is_staff(E.author_name(p["author_raw"]), site.staff).alias("is_staff"),
        p["publish_time"].alias("publish_time"),
        E.parse_stamp(p["publish_time"]).alias("publish_time_iso"),
        F.coalesce("lastmod", F.lit("")).alias("lastmod"),
        p["content"].alias("content"),
        word_count(p["content"]).alias("word_count"),
        F.length(p["content"]).alias("char_count"),
        E.first_number(F.col("page.reported")).alias("replies_reported"),
        (p.isNull() | (text == "")).alias("_failed"),
    )
    judged = with_relevance(posts, mode, topics=site.topics) if mode != "off" else with_relevance(posts, mode)
    return judged.withColumn("outcome", F.when(F.col("_failed"), "failed").when(F.col("_keep"), "kept").otherwise("skipped_irrelevant")).drop("_failed", "_keep")


def replies_of(parsed: DataFrame, site: SiteProfile) -> DataFrame:
    """Raw replies of parsed pages (url, page_no, page), numbered over all pages of the thread. Twins are kept."""
    r = parsed.select("url", "page_no", F.posexplode("page.replies").alias("pos", "r"))
    author = E.author_name(F.col("r.author_raw"))
    rows = r.select(
        E.last_segment(F.col("url")).alias("post_id"),
        F.col("url").alias("post_url"),
        "page_no",
        "pos",
        author.alias("author"),
        E.author_inactive(F.col("r.author_raw")).alias("author_inactive"),
        E.is_staff(author, site.staff).alias("is_staff"),
        F.col("r.publish_time").alias("publish_time"),
        E.parse_stamp(F.col("r.publish_time")).alias("publish_time_iso"),
        F.col("r.content").alias("content"),
        word_count(F.col("r.content")).alias("word_count"),
        E.first_number(F.col("r.foot")).alias("reactions"),
    )
    return with_reply_sequence(rows).select(*schemas.REPLY_COLUMNS)


def goes_on(pager: str, page_no: str, so_far: str, reported: str):
    """Whether the next page is asked for: the pager links to it, or fewer replies are there than reported."""
    return F.coalesce(F.array_contains(pager, F.col(page_no) + 1), F.lit(False)) | (F.col(so_far) < F.col(reported))


def assemble_threads(parsed: DataFrame, max_pages: int = fixed.MAX_REPLY_PAGES) -> DataFrame:
    """The pages that a page-by-page walk would have taken, of parsed pages that are all there.

    A page counts if every page before it was there, told to go on, and it has replies itself.
    """
    order = Window.partitionBy("url").orderBy("page_no")
    rows = parsed.where("page is not null").withColumns({"_n": F.coalesce(F.size("page.replies"), F.lit(0)), "_pager": F.col("page.pager_pages")})
    rows = rows.withColumns(
        {
            "_reported": F.first(E.first_number(F.col("page.reported"))).over(order),
            "_so_far": F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0)),
            "_rank": F.row_number().over(order),
        }
    )
    rows = rows.withColumn("_on", goes_on("_pager", "page_no", "_so_far", "_reported"))
    fits = (F.col("page_no") == F.col("_rank")) & ((F.col("page_no") == 1) | ((F.col("_n") > 0) & F.lag("_on").over(order))) & (F.col("page_no") <= max_pages)
    rows = rows.withColumn("_fits", fits).withColumn("_all", F.min(F.col("_fits").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.where("_all = 1").select("url", "page_no", "page")


def thread_records(posts: DataFrame, replies: DataFrame, walked: DataFrame, max_pages: int = fixed.MAX_REPLY_PAGES) -> DataFrame:
    """(post, replies) records of kept posts; walked: the pages taken (url, page_no)."""
    fetched = walked.groupBy("url").agg(F.max("page_no").alias("reply_pages_fetched"))
    struct = F.struct(*[F.col(c) for c in schemas.REPLY_COLUMNS])
    gathered = replies.groupBy("post_url").agg(F.array_sort(F.collect_list(F.struct("seq", struct.alias("r")))).alias("rs"))
    full = (
        posts.where("outcome = 'kept'")
        .join(fetched, "url", "left")
        .join(gathered.withColumnRenamed("post_url", "url"), "url", "left")
        .withColumn("replies", F.coalesce(F.transform("rs", lambda x: x["r"]), F.from_json(F.lit("[]"), f"array<struct<{', '.join(x.replace(' ', ': ', 1) for x in schemas.REPLY_FIELDS.split(', '))}>>")))
        .withColumns({"replies_scraped": F.size("replies"), "reply_pages_total": F.col("reply_pages_fetched"), "hit_page_cap": F.col("reply_pages_fetched") >= max_pages})
    )
    return full.select(F.struct(*[F.col(c) for c in schemas.POST_COLUMNS]).alias("post"), "replies")


def flatten(threads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(posts, replies) in their fixed columns."""
    posts = threads.select("post.*").select(*schemas.POST_COLUMNS)
    replies = threads.select(F.explode("replies").alias("r")).select("r.*").select(*schemas.REPLY_COLUMNS)
    return posts, replies


def crawl(spark: SparkSession, entries: DataFrame, checkpoint: str, fetcher: Fetcher, site: SiteProfile, mode: str = "terms", target: int | None = None, max_pages: int = fixed.MAX_REPLY_PAGES, resume: bool = True, batch: int = 200, outcome_log: str | None = None) -> tuple[dict[str, int], list[str]]:
    """Fetch what is new in entries (loc, lastmod, shard_file, pos), newest first, and append what is kept.

    The target counts threads that are kept, those of earlier runs included, so threads
    are fetched in batches until it is met. Returns counts by outcome and the first ten
    URLs that failed. Outcomes are forgotten, so all but kept threads are fetched again
    next time, unless outcome_log names a table to append them to.
    """
    done, failed = dict.fromkeys(OUTCOMES, 0), []
    have = _load(spark, checkpoint) if resume else None
    seen = have.select("post.url") if have is not None else spark.createDataFrame([], "url string")
    frontier = written(newest_first(new_entries(entries, seen)).select("loc", "lastmod", F.monotonically_increasing_id().alias("at")), "frontier")
    left = remaining(target, have.count() if have is not None else 0)
    after = -1
    while left is None or left > 0:
        part = frontier.where(F.col("at") > after).orderBy("at").limit(batch)
        last = part.agg(F.max("at")).first()[0]
        if last is None:
            break
        after = last
        posts, threads = _crawl_batch(part.select(F.col("loc").alias("url"), "lastmod", "at"), fetcher, site, mode, max_pages, left)
        append_checkpoint(threads, checkpoint)
        counts = dict(posts.groupBy("outcome").count().collect())
        for k in done:
            done[k] += counts.get(k, 0)
        if len(failed) < 10:
            failed += [r.url for r in posts.where("outcome = 'failed'").orderBy("at").select("url").limit(10 - len(failed)).collect()]
        if outcome_log:
            posts.select("url", "lastmod", "outcome", F.current_timestamp().alias("judged_at")).write.mode("append").parquet(outcome_log)
        if left is not None:
            left -= counts.get("kept", 0)
    return done, failed


def _load(spark: SparkSession, checkpoint: str) -> DataFrame | None:
    from ..sources.tables import file_facts

    return read_checkpoint(spark, checkpoint) if not file_facts(spark, checkpoint).isEmpty() else None


def _crawl_batch(part: DataFrame, fetcher: Fetcher, site: SiteProfile, mode: str, max_pages: int, left: int | None) -> tuple[DataFrame, DataFrame]:
    first = written(fetch_pages(part.select("url", F.lit(1).alias("page_no"), F.col("url").alias("page_url")), fetcher), "pages")
    parsed = written(parse_pages(first, site), "parsed")
    # A page can come without its body: it is fetched once more before the thread counts as failed.
    hollow = parsed.where(F.col("page.post").isNotNull() & (strip(F.coalesce("page.post.content", F.lit(""))) == ""))
    again = parse_pages(fetch_pages(hollow.select("url", "page_no", F.col("url").alias("page_url")), fetcher), site)
    again = written(again.where(strip(F.coalesce("page.post.content", F.lit(""))) != ""), "again")
    parsed = parsed.join(again.select("url"), "url", "left_anti").unionByName(again)
    posts = written(posts_of(parsed.join(part, "url"), site, mode).join(part.select("url", "at"), "url"), "posts")
    if left is not None:
        kept = posts.where("outcome = 'kept'").orderBy("at").limit(left).select("url")
        posts = written(posts.join(kept.withColumn("_in", F.lit(True)), "url", "left").where("outcome <> 'kept' or _in").drop("_in"), "posts")
    wanted = posts.where("outcome = 'kept'").select("url", "replies_reported")
    pages = parsed.join(wanted.select("url"), "url", "left_semi")
    taken = pages
    now = written(pages.select("url", "page_no", F.size("page.replies").alias("so_far"), F.col("page.pager_pages").alias("pager")).join(wanted, "url"), "walk")
    for page_no in range(2, max_pages + 1):
        go = now.where(goes_on("pager", "page_no", "so_far", "replies_reported"))
        if go.isEmpty():
            break
        urls = go.select("url", F.lit(page_no).alias("page_no"), F.concat("url", F.lit(f"?p={page_no}")).alias("page_url"))
        got = written(parse_pages(fetch_pages(urls, fetcher), site).where("size(page.replies) > 0"), "parsed")
        taken = taken.unionByName(got)
        now = written(
            got.join(go.select("url", "so_far", "replies_reported"), "url").select("url", "page_no", (F.col("so_far") + F.size("page.replies")).alias("so_far"), F.col("page.pager_pages").alias("pager"), "replies_reported"),
            "walk",
        )
    replies = replies_of(taken, site)
    return posts, thread_records(posts, replies, taken.select("url", "page_no"), max_pages)
