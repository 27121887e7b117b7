"""The registered queries of the engine itself, over the driver's tables.

The tables hold little of what cleaning is for, so queries add it: a fixed suffix for
documents by their id (DIRT), the same in SQL. Every query reads its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixed, schemas
from .functions import extract as E
from .functions import html as H
from .functions import text as X
from .operators import enrich, frontier, relevance
from .plans import clean, ingest, report
from .sources.scratch import folder, written
from .sources.tables import append_checkpoint, first_by, read_checkpoint, read_csv, read_sitemap_index, read_sitemap_shards, write_csv
from .streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]

SALT = "bench::"
STAFF = ("system",)

#: Added to texts, by id: links, mis-decoded and exotic characters, addresses, numbers, emoji, line ends.
DIRT = (
    ("3", "' see https://www.' || source || '.example.org/a/' || CAST(doc_id AS STRING) || '.'"),
    ("4", "' or (www.' || source || '.example.net/b), http://' || source || '.example.com:80/c?d=1!'"),
    ("5", "' that\u00e2\u20ac\u2122s caf\u00c3\u00a9 \u00c2\u00a9 \u00e2\u20ac\u0153so\u00e2\u20ac\u009d'"),
    ("7", "' a\u00a0b\u200bc\u3000d \u2018e\u2019 \u201cf\u201d\u2026'"),
    ("11", "' Mail.Me+x@Gmail.com, a.b@' || source || '.example.org.'"),
    ("13", "' \U0001f44d\U0001f3fd ❤️ ⭐'"),
    ("17", "'  \r\n\r\n\n\n end \r x \n'"),
    ("19", "' e\u0301 A\u030a'"),
    ("23", "' call 1-555-123-4567 or (555) 123-4567'"),
)


def dirty_sql(dialect: str) -> str:
    """The dirty text as an SQL expression over documents; both dialects differ in the name of the text type only."""
    parts = "".join(f" || CASE WHEN doc_id % {k} = 0 THEN {e} ELSE '' END" for k, e in DIRT)
    return ("text" + parts).replace("AS STRING", "AS STRING" if dialect == "spark" else "AS VARCHAR")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _docs(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Documents with dirt, dealt out: a table of one file with one row group is one task otherwise."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text", *columns)
    return _dealt(docs).withColumn("content", F.expr(dirty_sql("spark")))


SMALL_BYTES = 32 << 20


def _dealt(df: DataFrame) -> DataFrame:
    """A small input dealt over all cores: a file with one row group is one busy task otherwise. A large one as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * SMALL_BYTES else df


def _of_text(**columns) -> Query:
    """A query of expressions over the dirty text."""
    return lambda spark, sf_dir: _docs(spark, sf_dir).select("doc_id", *[f(F.col("content")).alias(name) for name, f in columns.items()])


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_text(_docs(spark, sf_dir))


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Written first: a filter on what an explode or a predicate needs would otherwise repeat the whole chain below it.
    return clean.links_of(written(_cleaned(spark, sf_dir).select("doc_id", "_links"), "links"), "doc_id", "post")


def _turns(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Conversations as threads: turn 0 is the post, later turns are replies, roles are authors."""
    t = _table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("post_id"), F.col("turn").cast("int").alias("turn"), F.col("role").alias("author"), F.col("text").alias("content"))
    replies = t.where("turn > 0").withColumns({"page_no": F.floor((F.col("turn") - 1) / 15).cast("int") + 1, "pos": F.col("turn"), "is_staff": E.is_staff(F.col("author"), STAFF)})
    return t.where("turn = 0"), enrich.with_reply_sequence(replies)


def q_clean_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _cleaned(spark, sf_dir)
    return c.select("doc_id", "content", "n_url", "n_email", "n_phone", "n_emoji", "text_changed", "_mojibake", X.word_count(F.col("content")).alias("word_count"), F.length("content").alias("char_count")).withColumnRenamed("_mojibake", "mojibake")


def q_email_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = report.email_domain_counts(written(_cleaned(spark, sf_dir).select("_email_domains"), "domains"))
    return counts.withColumn("personal", F.col("domain").isin(*fixed.PERSONAL_MAIL))


def _relevance(mode: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        docs = _dealt(_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"))
        judged = relevance.with_relevance(docs, mode, title="lang", content="text", topic_slug="source", **({} if mode == "off" else {"topics": ("src3", "src7")}))
        return written(judged.select("doc_id", "relevance_hits", "_keep"), "judged").where("_keep").select("doc_id", "relevance_hits")

    return run


def q_author_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _table(spark, sf_dir, "conversations")
    author = F.when(F.col("turn") % 5 == 4, None).otherwise(F.concat("role", F.lit(" "), F.col("conv_id").cast("string")))
    return t.select("conv_id", "turn", X.author_hash(author, SALT).alias("author_hash"))


def q_split_author(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _table(spark, sf_dir, "conversations")
    raw = F.concat(F.lit(" "), F.col("role"), F.when(F.col("turn") % 3 == 1, " ( INACTIVE ) ").when(F.col("turn") % 3 == 2, "(inactive)x").otherwise(""))
    return t.select("conv_id", "turn", E.author_name(raw).alias("author"), E.author_inactive(raw).alias("author_inactive"))


def q_staff_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _table(spark, sf_dir, "conversations")
    return t.select("conv_id", "turn", E.is_staff(F.concat(F.lit(" "), F.initcap("role")), STAFF).alias("is_staff"))


def q_parse_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.concat(F.lit("Posted "), F.date_format("ts", "MMM d, yyyy"), F.when(F.col("event_id") % 4 == 0, " - ").otherwise(" • "), F.date_format("ts", "h:mm a"))
    return _table(spark, sf_dir, "events").select("event_id", E.parse_stamp(stamp).alias("publish_time_iso"))


def q_is_op(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts, replies = _turns(spark, sf_dir)
    return enrich.with_is_op(replies, posts).select("reply_id", "author", "is_op")


def q_reply_seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _turns(spark, sf_dir)[1].select("post_id", "turn", "page_no", "seq", "reply_id")


def q_is_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = _turns(spark, sf_dir)[0].withColumn("word_count", X.word_count(F.col("content")))
    return posts.select("post_id", "word_count", enrich.is_short().alias("is_short"))


def q_thread_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, replies = _turns(spark, sf_dir)
    return replies.groupBy("post_id").agg(F.count(F.lit(1)).alias("replies"), F.count_if("is_staff").alias("staff_replies"), F.max("seq").alias("last_seq"), F.sum(X.word_count(F.col("content"))).alias("words"))


def q_subset_nonstaff_nonop(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts, replies = _turns(spark, sf_dir)
    flagged = enrich.with_is_op(replies, posts).withColumn("publish_time_iso", F.lit(""))
    return enrich.research_subsets(flagged)["non_staff_non_op"].select("reply_id", "author", "is_staff", "is_op")


def q_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_linenumber").alias("replies_reported"), F.count(F.lit(1)).alias("replies_scraped"))
    return lines.select("l_orderkey", "replies_reported", "replies_scraped", enrich.is_incomplete().alias("is_incomplete"), (F.col("replies_scraped") >= 7).alias("hit_page_cap"))


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("url", "page_id")
    return pages.select(F.col("url").alias("loc"), F.when(F.col("page_id") % 9 == 0, "").otherwise(F.concat(F.lit("2024-01-"), F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0"))).alias("lastmod"), F.lit("shard_1").alias("shard_file"), F.col("page_id").alias("pos"))


def q_frontier_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = _entries(spark, sf_dir)
    seen = entries.where("pos % 4 = 1").select(F.col("loc").alias("url"))
    return frontier.new_entries(entries.unionByName(entries.where("pos % 5 = 0")), seen).select("loc", "lastmod")


def q_frontier_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontier.newest_first(_entries(spark, sf_dir)).select("loc", "lastmod", "pos")


def q_dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value")
    return first_by(events, ["user_id", "event_type"], ["event_id"])


def _threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as checkpoint records; columns that they don't have are null."""
    posts, replies = _turns(spark, sf_dir)
    stamp = lambda c: F.concat(F.lit("2024-01-"), F.lpad((F.col(c).cast("int") % 28 + 1).cast("string"), 2, "0"))
    fields = lambda known, all_fields: F.struct(*[(known[n] if n in known else F.lit(None)).cast(k).alias(n) for n, k in (x.split() for x in all_fields.split(", "))])
    reply = {n: F.col(n) for n in ("reply_id", "post_id", "seq", "page_no", "author", "is_staff", "content")} | {"publish_time_iso": stamp("turn")}
    nested = replies.groupBy("post_id").agg(F.array_sort(F.collect_list(F.struct("seq", fields(reply, schemas.REPLY_FIELDS).alias("r")))).alias("rs"))
    post = {n: F.col(n) for n in ("post_id", "author", "content")} | {"url": F.concat(F.lit("https://example.org/discussion/"), "post_id"), "publish_time_iso": stamp("post_id")}
    none = F.array().cast(f"array<struct<{', '.join(x.replace(' ', ': ', 1) for x in schemas.REPLY_FIELDS.split(', '))}>>")
    records = posts.select("post_id", fields(post, schemas.POST_FIELDS).alias("post")).join(nested, "post_id", "left")
    return records.select("post", F.coalesce(F.transform("rs", lambda x: x["r"]), none).alias("replies"))


def q_checkpoint_nest_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A checkpoint that is appended to twice, the second time with half of the threads again, read back and flattened."""
    path = folder(spark, "checkpoint")
    threads = _threads(spark, sf_dir)
    append_checkpoint(threads, path)
    append_checkpoint(threads.where("CAST(post.post_id AS int) % 2 = 0"), path)
    posts, replies = ingest.flatten(read_checkpoint(spark, path))
    authors = posts.select("post_id", F.col("author").alias("post_author"))
    return replies.join(authors, "post_id").select("post_id", "post_author", "seq", "reply_id", "author", F.length("content").alias("chars"))


def q_checkpoint_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark, "checkpoint")
    append_checkpoint(_threads(spark, sf_dir), path)
    append_checkpoint(_threads(spark, sf_dir), path)
    return ingest.flatten(read_checkpoint(spark, path))[0].select("post_id", "url", "author", "content", "publish_time_iso")


def q_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with quotes and line feeds through CSV files and back."""
    t = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.concat(F.lit('say "a, b"\nand '), "text", F.lit("\n\n,end")).alias("text"))
    path = folder(spark, "csv")
    write_csv(t, path)
    return read_csv(spark, path, "conv_id long, turn long, role string, text string")


_BODY = "'m ' || trim(regexp_replace(text, '[^A-Za-z0-9]+', ' '))"


def _thread_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as thread pages (url, page_no, html): two replies a page, an empty one besides; page 2 of every fifth thread is missing."""
    t = _table(spark, sf_dir, "conversations").selectExpr("conv_id", "turn", "role", f"{_BODY} AS body")
    replies = t.where("turn > 0").withColumn("page_no", F.ceil(F.col("turn") / 2).cast("int"))
    one = F.concat(F.lit('<ins-anon-reply><b class="rhb-name"> '), "role", F.when(F.col("turn") % 3 == 0, " (Inactive)").otherwise(""), F.lit(' </b><span class="rhb-stamp">Jan '), F.col("turn") + 1, F.lit(", 2024 • 3:0"), F.col("turn") % 10, F.lit(' PM</span><p>'), "body", F.lit('</p><p> </p><span class="rbw-foot">liked by '), "turn", F.lit("</span></ins-anon-reply>"))
    by_page = replies.groupBy("conv_id", "page_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", one.alias("h")))), lambda x: x["h"]), "").alias("replies"))
    size = replies.groupBy("conv_id").agg(F.max("page_no").alias("pages"), F.count(F.lit(1)).alias("n"))
    posts = t.where("turn = 0").select("conv_id", "role", "body").join(size, "conv_id", "left").fillna({"pages": 1, "n": 0})
    path = F.concat(F.lit("/discussion/conv-"), "conv_id")
    pager = F.array_join(F.transform(F.sequence(F.lit(1), F.col("pages")), lambda k: F.concat(F.lit('<a href="'), path, F.lit("/?p="), k, F.lit('">'), k, F.lit("</a>"))), "")
    post = F.concat(
        F.lit('<app-individual-post><h1 class="pb-title">Title <i>'), "conv_id", F.lit('</i></h1><a class="pb-topic" href="/topics/t-'), F.col("conv_id") % 3, F.lit('/">Topic</a><span class="pb-author-name">'), "role",
        F.lit('</span><span class="pb-created-date">Feb 3, 2024 • 12:05 AM</span><div class="pb-desc"><script>no</script>'), F.when(F.col("conv_id") % 4 != 1, F.col("body")).otherwise(" "), F.lit("</div></app-individual-post>"),
    )
    pages = posts.withColumn("page_no", F.explode(F.sequence(F.lit(1), F.col("pages")))).where("NOT (conv_id % 5 = 0 AND page_no = 2)").join(by_page, ["conv_id", "page_no"], "left")
    foreign = F.lit('<a href="/discussion/other?p=77">77</a><a href="https://example.org/discussion/conv-1?p=78">78</a>')
    html = F.concat(F.lit("<html><body>"), F.when(F.col("page_no") == 1, post).otherwise(""), F.lit('<div class="number-of-replies">'), F.col("n"), F.lit(" replies</div>"), F.coalesce("replies", F.lit("")), F.lit("<ins-anon-reply><p> </p></ins-anon-reply>"), pager, foreign)
    return pages.select(F.concat(F.lit("https://example.org"), path).alias("url"), "page_no", html.alias("html"))


_SITE = fixed.SiteProfile(staff=STAFF, topics=("t-0", "t-1"))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(ingest.parse_pages(_dealt(_thread_pages(spark, sf_dir)), _SITE), "parsed")


def _posts(parsed: DataFrame) -> DataFrame:
    return ingest.posts_of(parsed.where("page_no = 1").withColumn("lastmod", F.lit("2024-02-03")), _SITE, "topic")


def q_thread_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = "post_id url title topic topic_slug author author_inactive is_staff publish_time publish_time_iso lastmod content word_count char_count replies_reported outcome".split()
    return _posts(_parsed(spark, sf_dir)).select(*columns)


def q_thread_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _posts(_parsed(spark, sf_dir)).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def q_thread_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    replies = ingest.replies_of(_parsed(spark, sf_dir), _SITE)
    return replies.select("reply_id", "post_id", "post_url", "seq", "page_no", "author", "author_inactive", "is_staff", "publish_time", "publish_time_iso", "content", "word_count", "reactions")


def q_thread_pager(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _parsed(spark, sf_dir)
    return parsed.select("url", "page_no", F.array_join("page.pager_pages", ",").alias("pager"), E.first_number(F.col("page.reported")).alias("reported"), F.size("page.replies").alias("replies"))


def q_thread_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.assemble_threads(_parsed(spark, sf_dir)).select("url", "page_no")


def q_thread_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of kept threads, of two pages at most."""
    parsed = _parsed(spark, sf_dir)
    walked = written(ingest.assemble_threads(parsed, max_pages=2), "walked")
    records = ingest.thread_records(_posts(parsed), ingest.replies_of(walked, _SITE), walked.select("url", "page_no"), max_pages=2)
    return records.select("post.post_id", "post.replies_reported", "post.replies_scraped", "post.reply_pages_fetched", "post.hit_page_cap", F.size("replies").alias("n"))


def _xml(entries: DataFrame, root: str, path: str) -> None:
    """Entries (page_id, x) as XML files of at most 10,000 each."""
    shard = F.floor(F.col("page_id") / 10_000).alias("shard")
    files = entries.groupBy(shard).agg(F.concat(F.lit(f"<{root}>"), F.array_join(F.collect_list("x"), ""), F.lit(f"</{root}>")).alias("xml"))
    files.write.partitionBy("shard").text(path)


def q_sitemap_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    name = F.when(F.col("page_id") % 3 == 0, "sitemap_disc_other__").when(F.col("page_id") % 3 == 1, "sitemap_disc_group__").otherwise("sitemap_group__")
    path = folder(spark, "sitemap")
    _xml(pages.select("page_id", F.concat(F.lit("<sitemap><loc> https://example.org/"), name, "page_id", F.lit(".xml </loc></sitemap>")).alias("x")), "sitemapindex", path)
    return read_sitemap_index(spark, path, "group")


def q_sitemap_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    loc = F.concat(F.when(F.col("page_id") % 3 == 0, "https://example.org/news/").otherwise("https://example.org/discussion/"), "page_id", F.lit("?a=1&amp;b=2"))
    stamp = F.when(F.col("page_id") % 4 == 0, "").otherwise(F.concat(F.lit("<lastmod> 2024-01-"), F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0"), F.lit("</lastmod>")))
    path = folder(spark, "sitemap")
    _xml(pages.select("page_id", F.concat(F.lit("<url><loc>"), loc, F.lit("</loc>"), stamp, F.lit("</url>")).alias("x")), "urlset", path)
    return read_sitemap_shards(spark, path).select("loc", "lastmod")


def _subset(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        posts, replies = _turns(spark, sf_dir)
        flagged = enrich.with_is_op(replies, posts).withColumn("publish_time_iso", F.when(F.col("turn") % 6 == 5, "").otherwise(F.concat((F.lit(2013) + F.col("turn")).cast("string"), F.lit("-03-04T05:06:00"))))
        return enrich.research_subsets(flagged)[name].select("reply_id", "author", "publish_time_iso")

    return run


def q_frontier_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a cumulative target of all known threads and forty more leaves to fetch, newest first."""
    entries = _entries(spark, sf_dir)
    seen = entries.where("pos % 4 = 1").select(F.col("loc").alias("url"))
    have = seen.count()
    return frontier.newest_first(frontier.new_entries(entries, seen)).limit(frontier.remaining(have + 40, have)).select("loc", "lastmod")


def q_corpus_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _cleaned(spark, sf_dir).withColumns({"word_count": X.word_count(F.col("content")), "author_inactive": F.col("doc_id") % 10 == 0, "is_staff": F.col("doc_id") % 12 == 0, "is_op": F.col("doc_id") % 15 == 0})
    docs = docs.withColumn("is_short", enrich.is_short())
    return report.corpus_totals(docs.where("doc_id % 4 = 0"), docs.where("doc_id % 4 <> 0"))


def q_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark, "checkpoint")
    append_checkpoint(_threads(spark, sf_dir), path)
    return report.checkpoint_totals(read_checkpoint(spark, path, distinct=False))


def q_html_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _dealt(_table(spark, sf_dir, "pages"))
    a = pages.select("page_id", H.article_reader()("html").alias("a"))
    return a.select("page_id", F.col("a.title").alias("title"), F.size("a.paragraphs").alias("paragraphs"), F.size("a.links").alias("links"))


def q_html_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _dealt(_table(spark, sf_dir, "pages"))
    return pages.select("page_id", F.posexplode(H.article_reader()("html")["paragraphs"]).alias("pos", "paragraph"))


def q_stream_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events arriving as files, one row kept for each user and type; two runs, the second finds nothing."""
    source = _table(spark, sf_dir, "events")
    # A pattern, as the table is one file here and a folder there.
    stream = spark.readStream.schema(source.schema).parquet(f"{sf_dir}/events.parque[t]")
    keyed = stream.select(F.concat_ws("/", "user_id", "event_type").alias("key"), "event_id", "value")
    sink, state = folder(spark, "sink"), folder(spark, "state")
    for _ in range(2):
        incremental.run_available(keyed, incremental.append_new(spark, sink, "key", ["event_id"]), state)
    return spark.read.schema(keyed.schema).parquet(sink)


def queries() -> dict[str, Query]:
    return {
        "q_mask_email": _of_text(masked=X.mask_emails, n_email=lambda t: F.size(X.matches(t, X.EMAIL))),
        "q_mask_phone": _of_text(masked=X.mask_phones, n_phone=X.count_phones),
        "q_mask_url": _of_text(masked=X.mask_urls),
        "q_mask_www": _of_text(masked=lambda t: X.mask_bare_urls(X.mask_urls(t))),
        "q_mojibake": _of_text(fixed=X.fix_mojibake),
        "q_nfc": _of_text(composed=X.nfc),
        "q_unicode_fold": _of_text(folded=X.fold_unicode),
        "q_emoji_count": _of_text(n_emoji=X.count_emoji),
        "q_tidy_whitespace": _of_text(tidy=X.tidy_whitespace),
        "q_lengths": _of_text(word_count=X.word_count, char_count=F.length),
        "q_text_changed": lambda s, d: _cleaned(s, d).select("doc_id", "text_changed"),
        "q_clean_full": q_clean_full,
        "q_links": lambda s, d: _links(s, d).select("doc_id", "doc_type", "domain", "url", "pos"),
        "q_links_top_domains": lambda s, d: report.top_domains(_links(s, d)),
        "q_links_distinct": lambda s, d: report.distinct_domains(_links(s, d)),
        "q_email_domains": q_email_domains,
        "q_domain_of": lambda s, d: _table(s, d, "pages").select("page_id", X.domain_of(F.col("url")).alias("domain")),
        "q_post_id": lambda s, d: _table(s, d, "pages").select("page_id", E.last_segment(F.col("url")).alias("post_id")),
        "q_lexicon_hits": lambda s, d: _dealt(_table(s, d, "documents").select("doc_id", "text")).select("doc_id", F.array_join(E.lexicon_hits(F.col("text")), "|").alias("hits")),
        "q_relevance_terms": _relevance("terms"),
        "q_relevance_topic": _relevance("topic"),
        "q_relevance_off": _relevance("off"),
        "q_author_hash": q_author_hash,
        "q_split_author": q_split_author,
        "q_staff_flag": q_staff_flag,
        "q_parse_stamp": q_parse_stamp,
        "q_is_op": q_is_op,
        "q_is_short": q_is_short,
        "q_reply_seq": q_reply_seq,
        "q_thread_rollup": q_thread_rollup,
        "q_subset_nonstaff_nonop": q_subset_nonstaff_nonop,
        "q_completeness": q_completeness,
        "q_frontier_new": q_frontier_new,
        "q_frontier_order": q_frontier_order,
        "q_dedupe_first": q_dedupe_first,
        "q_checkpoint_nest_flatten": q_checkpoint_nest_flatten,
        "q_checkpoint_posts": q_checkpoint_posts,
        "q_csv_round_trip": q_csv_round_trip,
        "q_thread_posts": q_thread_posts,
        "q_thread_outcomes": q_thread_outcomes,
        "q_thread_replies": q_thread_replies,
        "q_thread_pager": q_thread_pager,
        "q_thread_walk": q_thread_walk,
        "q_thread_records": q_thread_records,
        "q_sitemap_index": q_sitemap_index,
        "q_sitemap_shards": q_sitemap_shards,
        "q_subset_nonstaff": _subset("non_staff"),
        "q_subset_recent": _subset("recent"),
        "q_frontier_target": q_frontier_target,
        "q_corpus_report": q_corpus_report,
        "q_status": q_status,
        "q_html_article": q_html_article,
        "q_html_paragraphs": q_html_paragraphs,
        "q_stream_incremental": q_stream_incremental,
    }
