"""The cleaning plan: raw posts and replies to clean posts, replies and links. Rows are flagged, never dropped."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text as X
from ..operators.enrich import is_short, with_is_op
from ..sources.scratch import written
from ..sources.tables import write_csv

#: Internal columns of a cleaned table, for links and reports.
INTERNAL = ("_links", "_mojibake", "_email_domains")


def clean_text(df: DataFrame, column: str = "content", steps: bool = False) -> DataFrame:
    """df with the column cleaned, the counters of CLEAN_COLUMNS, and INTERNAL columns.

    In order: mojibake, Unicode, (emoji count), URLs, bare URLs, e-mails, phones, white
    space. Missing text is empty text. steps=True keeps the stages, named _t_*.
    """
    chain = df.withColumn("_t_raw", F.coalesce(F.col(column), F.lit("")))
    for name, expr in (
        ("_t_mojibake", X.fix_mojibake(F.col("_t_raw"))),
        ("_t_nfc", X.nfc(F.col("_t_mojibake"))),
        ("_t_fold", X.fold_unicode(F.col("_t_nfc"))),
        ("_t_url", X.mask_urls(F.col("_t_fold"))),
        ("_t_www", X.mask_bare_urls(F.col("_t_url"))),
        ("_t_email", X.mask_emails(F.col("_t_www"))),
        ("_t_phone", X.mask_phones(F.col("_t_email"))),
        ("_t_tidy", X.tidy_whitespace(F.col("_t_phone"))),
    ):
        chain = chain.withColumn(name, expr)
    out = chain.withColumns(
        {
            "_links": X.links_in(F.col("_t_fold"), F.col("_t_url")),
            "_mojibake": F.col("_t_mojibake") != F.col("_t_raw"),
            "_email_domains": X.email_domains(F.col("_t_www")),
            "n_email": X.matches(F.col("_t_www"), X.EMAIL),
            "n_phone": X.count_phones(F.col("_t_email")),
            "n_emoji": X.count_emoji(F.col("_t_fold")),
            "text_changed": F.col("_t_tidy") != F.col("_t_raw"),
            column: F.col("_t_tidy"),
        }
    ).withColumns({"n_url": F.size("_links"), "n_email": F.size("n_email")})
    return out if steps else out.drop(*[c for c in out.columns if c.startswith("_t_")])


def with_derived(cleaned: DataFrame, salt: str, column: str = "content") -> DataFrame:
    """Lengths of the cleaned text and the author's hash."""
    return cleaned.withColumns({"word_count": X.word_count(F.col(column)), "char_count": F.length(column), "author_hash": X.author_hash(F.col("author"), salt)})


def links_of(cleaned: DataFrame, id_col: str, doc_type: str) -> DataFrame:
    """One row for each link, with its position in the document."""
    return cleaned.select(F.col(id_col).alias("doc_id"), F.lit(doc_type).alias("doc_type"), F.posexplode("_links").alias("pos", "l")).select("doc_id", "doc_type", "l.domain", "l.url", "pos")


@dataclass(frozen=True)
class CleanCorpus:
    posts: DataFrame
    replies: DataFrame
    links: DataFrame
    #: Both with INTERNAL columns, for the report.
    posts_full: DataFrame
    replies_full: DataFrame


def clean_corpus(posts: DataFrame, replies: DataFrame, salt: str, check_ids: bool = True, persist: bool = True) -> CleanCorpus:
    """Clean both tables. They are written once to the shared folder, as content, links and report all read them."""
    keep = written if persist else (lambda df, tag: df)
    p = with_derived(clean_text(posts), salt).withColumn("is_short", is_short())
    r = with_is_op(with_derived(clean_text(replies), salt), posts, check_ids)
    p, r = keep(p, "posts"), keep(r, "replies")
    links = links_of(p, "post_id", "post").unionByName(links_of(r, "reply_id", "reply"))
    order = lambda raw, *more: [*raw, *[c for c in (*schemas.CLEAN_COLUMNS, *more) if c not in raw]]
    return CleanCorpus(
        p.select(*order(schemas.POST_COLUMNS, "author_hash", "is_short")),
        r.select(*order(schemas.REPLY_COLUMNS, "char_count", "author_hash", "is_op")),
        links.select(*schemas.LINK_COLUMNS),
        p,
        r,
    )


def write_clean(corpus: CleanCorpus, path: str, csv: bool = True) -> None:
    """posts, replies and links below path: as CSV, or as Parquet."""
    for name, df in (("posts", corpus.posts), ("replies", corpus.replies), ("links", corpus.links)):
        write_csv(df, f"{path}_{name}") if csv else df.write.mode("overwrite").parquet(f"{path}_{name}")
