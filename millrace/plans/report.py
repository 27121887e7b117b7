"""What a cleaning run did, and the state of a checkpoint: small aggregates, rendered on the driver."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..sources.tables import file_facts, read_checkpoint
from .clean import CleanCorpus


def corpus_totals(posts: DataFrame, replies: DataFrame) -> DataFrame:
    """One row of counts over the cleaned tables (with internal columns), in one pass of partial sums."""
    some = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    number = lambda df, column, default: df[column] if column in df.columns else F.lit(default)
    part = lambda df, kind: df.select(
        F.lit(kind).alias("kind"), "n_url", "n_email", "n_phone", "n_emoji", "text_changed", "_mojibake", "author_inactive",
        number(df, "is_staff", False).alias("is_staff"), number(df, "is_op", False).alias("is_op"), number(df, "is_short", False).alias("is_short"), "word_count",
    )
    both = part(posts, "post").unionByName(part(replies, "reply"))
    is_reply = F.col("kind") == "reply"
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return both.agg(
        some(~is_reply).alias("posts"),
        some(is_reply).alias("replies"),
        some(F.col("_mojibake")).alias("mojibake_docs"),
        total("n_url").alias("urls"),
        total("n_email").alias("emails"),
        total("n_phone").alias("phones"),
        some(F.col("text_changed")).alias("changed"),
        some(F.col("n_emoji") > 0).alias("with_emoji"),
        some(is_reply & F.col("is_staff")).alias("staff_replies"),
        some(is_reply & F.col("is_op")).alias("op_replies"),
        some(F.col("author_inactive")).alias("inactive_docs"),
        some(~is_reply & F.col("is_short")).alias("short_posts"),
        total("word_count").alias("words"),
    )


def top_domains(links: DataFrame, n: int = 15) -> DataFrame:
    """The most linked domains; equal counts in code point order."""
    return links.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "domain").limit(n)


def distinct_domains(links: DataFrame) -> DataFrame:
    return links.agg(F.count(F.lit(1)).alias("links"), F.count_distinct("domain").alias("domains"))


def email_domain_counts(*cleaned: DataFrame) -> DataFrame:
    domains = reduce(DataFrame.unionByName, [df.select(F.explode("_email_domains").alias("domain")) for df in cleaned])
    return domains.groupBy("domain").agg(F.count(F.lit(1)).alias("n"))


def render_report(corpus: CleanCorpus) -> str:
    t = corpus_totals(corpus.posts_full, corpus.replies_full).first()
    links = distinct_domains(corpus.links).first()
    table = [
        ("mojibake fixed", t.mojibake_docs, "documents"),
        ("links masked", t.urls, "occurrences"),
        ("e-mails masked", t.emails, "occurrences"),
        ("phone numbers masked", t.phones, "occurrences"),
        ("text changed", t.changed, "documents"),
        ("with emoji (kept)", t.with_emoji, "documents"),
        ("is_staff", t.staff_replies, "replies"),
        ("is_op", t.op_replies, "replies"),
        ("author_inactive", t.inactive_docs, "documents"),
        (f"is_short (under {fixed.SHORT_POST_WORDS} words)", t.short_posts, "posts"),
    ]
    lines = [f"posts    {t.posts:,} rows, {len(corpus.posts.columns)} columns", f"replies  {t.replies:,} rows, {len(corpus.replies.columns)} columns", f"links    {links.links:,} rows, {links.domains:,} domains", f"words    {t.words:,}", ""]
    lines += [f"{name:<28}{n:>12,} {unit}" for name, n, unit in table]
    lines += ["", "Most linked domains:", *[f"{r.n:>8,}  {r.domain}" for r in top_domains(corpus.links).collect()]]
    return "\n".join(lines)


def checkpoint_totals(threads: DataFrame) -> DataFrame:
    """threads, replies and the newest times (as text; empty if there are none) of a checkpoint, unread duplicates included."""
    newest = F.array_max(F.transform("replies", lambda r: F.coalesce(r["publish_time_iso"], F.lit(""))))
    return threads.agg(
        F.count(F.lit(1)).alias("threads"),
        F.coalesce(F.sum(F.coalesce(F.size("replies"), F.lit(0))), F.lit(0)).cast("long").alias("replies"),
        F.coalesce(F.max(F.coalesce("post.publish_time_iso", F.lit(""))), F.lit("")).alias("newest_post"),
        F.coalesce(F.max(newest), F.lit("")).alias("newest_reply"),
    )


def status(spark: SparkSession, checkpoint: str, tables: dict[str, str], size_hint: int = fixed.CORPUS_SIZE_HINT) -> str:
    """The state of the corpus as text."""
    size = lambda facts: f"{sum(f.bytes for f in facts) / 1e6:,.1f} MB, {max(f.modified for f in facts):%Y-%m-%d %H:%M}"
    files = file_facts(spark, checkpoint).collect()
    if not files:
        return "No data yet."
    t = checkpoint_totals(read_checkpoint(spark, checkpoint, distinct=False)).first()
    lines = [
        f"checkpoint   {size(files)}",
        f"threads      {t.threads:,} of about {size_hint:,} ({t.threads / size_hint * 100:.1f} %)",
        f"replies      {t.replies:,}",
        f"newest post  {t.newest_post[:10]}, newest reply {t.newest_reply[:10]}",
        "",
    ]
    for name, path in tables.items():
        facts = file_facts(spark, path).collect()
        lines.append(f"{name:<14} {size(facts) if facts else 'not there yet'}")
    return "\n".join(lines)
