"""The registered queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, language_id, license_scan, line_dedup, mixing, near_dedup, sharding, substring_dedup, url_filters, vector_search
from .common import table

#: The rules that op2 has to know.
URL_RULES = (
    ("block", "com/en/"),
    ("allow", "example.com/en/7"),
    ("allow", "net/de/"),
    ("block", "example.net/de/8"),
    ("block", "org/es/"),
)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"), window=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [*[url_filters.prefix_rule(*r) for r in URL_RULES], *url_filters.DEFAULT_PATTERNS]
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict", "pattern_rule")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_records(table(spark, sf_dir, "documents"), shards=16)
    return out.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2, percent=80)


def op7_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"), window=8, min_items=2)
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=20, min_docs=3)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "copies")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_url_filters": op2_url_filters,
        "op3_language_id": op3_language_id,
        "op4_license_scan": op4_license_scan,
        "op5_sharding": op5_sharding,
        "op6_near_dedup": op6_near_dedup,
        "op7_vector_search": op7_vector_search,
        "op8_decontamination": op8_decontamination,
        "op9_line_dedup": op9_line_dedup,
        "op10_mixing": op10_mixing,
    }
