"""The training-data pipeline: five stages over documents, each an operator of millrace.llm.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept; what it
returns is written as Parquet and read again as the next stage's docs. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, language_id, mixing, near_dedup, sharding
from millrace.llm.common import apart, materialise, table, temporary


#: A document is rejected if its language is less likely than all others together.
MIN_LANGUAGE_SCORE = 0.5


def detect_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter (or without text) go, and those whose best language has a score below
    MIN_LANGUAGE_SCORE: no language is theirs. Where no language could be learned, letters alone decide."""
    found = language_id.identify(docs)
    known = F.col("lang_pred") != language_id.UNKNOWN
    return found.where(F.when(known, F.col("score") >= MIN_LANGUAGE_SCORE).otherwise(F.col("text").rlike(r"\p{L}"))).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays, that with the smallest id: five-word shingles, similarity of 0.8 or more.

    Rows are numbered for it, so those without id or with a repeated one are judged like others.
    """
    row = apart(docs, "__row")[0]
    rows = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "rows", keep=True)
    found = near_dedup.near_duplicates(rows, shingle_words=5, percent=80, id_col=row).select(row, "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", row)
    stay = rows.select(row, "doc_id").join(found, row).groupBy("component_id").agg(F.min(order).alias("m"))
    return rows.join(stay.select(f"m.{row}"), row, "left_semi").select(*docs.columns)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold eight consecutive words of a benchmark item go.

    An item of fewer words is often a common phrase, so quoting it whole is not enough: a
    document goes by such items where they are half of its words or more.
    """
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"), window=8)
    short = (F.col("n_hit") > 0) & (2 * F.col("n_hit") >= F.col("n_words"))
    return found.where(~((F.col("longest_match") >= 8) | short)).select(*docs.columns)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it: twice, once or not at all."""
    return mixing.expand_copies(mixing.mix_sources(docs)).select(*docs.columns)


def deal_into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in one random order over 16 shards."""
    return sharding.shard_records(docs, shards=16)


STAGES = [
    ("language_id", detect_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("mixing", mix_to_weights),
    ("sharding", deal_into_shards),
]

#: Language models, min-hashing and seeded shuffles aren't SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with temporary(spark):  # what the stage wrote on its way goes once its result is written
            kept = materialise(stage(spark, docs, sf_dir), name, keep=True)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
