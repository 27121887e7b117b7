"""Reading and writing the stored tables: CSV, JSON lines, Parquet, sitemap XML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas

#: What a lenient CSV reader takes for missing; for read_csv(missing=PANDAS_MISSING).
PANDAS_MISSING = ("#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def read_csv(spark: SparkSession, path: str, fields: str, missing: tuple[str, ...] = ()) -> DataFrame:
    """A CSV table with a header, quoted line feeds and an optional byte order mark; empty fields are null."""
    df = spark.read.schema(fields).csv(path, header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8", enforceSchema=True)
    if missing:
        text = [c for c, kind in df.dtypes if kind == "string"]
        df = df.withColumns({c: F.when(~F.col(c).isin(*missing), F.col(c)) for c in text})
    return df


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; every file begins with a byte order mark, which goes before the first column's name."""
    marked = df.withColumnRenamed(df.columns[0], f"\ufeff{df.columns[0]}")
    marked.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="")


def read_sitemap_index(spark: SparkSession, path: str, group: str) -> DataFrame:
    """Locations of the group's discussion shards, in order of their number."""
    index = spark.read.format("xml").option("rowTag", "sitemap").schema("loc string").load(path)
    name = rf"sitemap_disc_\Q{group}\E__(\d+)\.xml\z"
    shard = F.regexp_extract(F.trim("loc"), name, 1)
    return index.where(F.trim("loc").rlike(name)).select(F.trim("loc").alias("loc"), shard.cast("int").alias("shard_no"))


def read_sitemap_shards(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(loc, lastmod, shard_file, pos) of every discussion URL; pos keeps the order within a shard."""
    rows = spark.read.format("xml").option("rowTag", "url").schema(schemas.SITEMAP_FIELDS).load(paths if isinstance(paths, str) else ",".join(paths))
    return (
        rows.select("loc", "lastmod", F.input_file_name().alias("shard_file"), F.monotonically_increasing_id().alias("pos"))
        .where(F.col("loc").contains("/discussion/"))
        .withColumns({"loc": F.trim("loc"), "lastmod": F.coalesce(F.trim("lastmod"), F.lit(""))})
    )


def read_checkpoint(spark: SparkSession, path: str, distinct: bool = True) -> DataFrame:
    """Threads of a JSON-lines checkpoint. Blank, broken and non-object lines go; the first record of a URL stays.

    Order is that of the files' times, then of names and lines.
    """
    lines = spark.read.schema(schemas.checkpoint_fields()).option("mode", "DROPMALFORMED").json(path)
    if not distinct:
        return lines.where("post is not null")
    seen = lines.select(
        "post", "replies", F.col("_metadata.file_modification_time").alias("_t"), F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_i")
    ).where("post is not null")
    return first_by(seen, ["post.url"], ["_t", "_f", "_b", "_i"]).select("post", "replies")


def append_checkpoint(threads: DataFrame, path: str) -> None:
    threads.select("post", "replies").write.mode("append").json(path)


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of every key in a given order (dropDuplicates promises none). Partial results are merged, so no key's rows meet in one task."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    first = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min_by(row, F.struct(*[F.col(o) for o in order])).alias("_first"))
    return first.select("_first.*")


def file_facts(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, modified) of the files at path; no rows if there are none. Contents aren't read."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(conf)
    rows = []
    for s in fs.globStatus(where) or []:
        files = fs.listStatus(s.getPath()) if s.isDirectory() else [s]
        rows += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files if not f.getPath().getName().startswith(("_", "."))]
    return spark.createDataFrame(rows, "path string, bytes long, ms long").select("path", "bytes", F.timestamp_millis("ms").alias("modified"))
