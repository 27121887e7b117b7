"""What the operators of this subpackage share: scratch tables and input measures."""

from __future__ import annotations

import math
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words are maximal runs of anything but ASCII white space.
SPACE_WORD = r"[^\x20\x09-\x0D]+"


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: spark.checkpoint.dir. Where it is unset, a local one in local mode alone (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


_open: list[list[str]] = []


def materialise(df: DataFrame, tag: str, keep: bool = False) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts lineage, survives lost executors.

    Within temporary() the table goes when that ends, unless it is to be kept because a
    result still reads it; then it is left to the temporary() around that one, if any.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    for paths in (_open[:-1] if keep else _open)[-1:]:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Tables materialised within are deleted at its end: nothing lazy may read them by then."""
    _open.append([])
    try:
        yield
    finally:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in _open.pop():
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)


BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Send texts to Python in Arrow batches of at most 8 MB, so that long texts don't add up in executors' memory.

    A session setting, which stays: plans read it when they start.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def measure(df: DataFrame, text_col: str) -> tuple[int, int]:
    """(rows, UTF-8 bytes of the texts), in one pass that keeps one row per task."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text_col)).alias("b")).first()
    return row["n"], row["b"] or 0


def pieces(total: int, each: int, least: int = 1) -> int:
    return max(least, math.ceil(total / each))


MOST_PARTITIONS = 50_000


def partitions(groups: int) -> int:
    """As many partitions as groups, up to a number that the driver can schedule; then each takes several groups."""
    return min(groups, MOST_PARTITIONS)


def row_hash(*cols: str | Column) -> Column:
    """A hash that spreads rows even where an id is null or repeated."""
    return F.xxhash64(*cols)


def without(df: DataFrame, *names: str) -> DataFrame:
    """df without columns of these names, in any case: an operator's own outputs replace them."""
    clash = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in clash])


def apart(df: DataFrame, *names: str) -> list[str]:
    """These names, with as many underscores before them as keep them apart from all columns of df."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def hashable(df: DataFrame) -> list[Column]:
    """All columns in a form that can be hashed: those that hold maps as JSON."""

    def holds_map(t: T.DataType) -> bool:
        inner = [f.dataType for f in t.fields] if isinstance(t, T.StructType) else [t.elementType] if isinstance(t, T.ArrayType) else []
        return isinstance(t, (T.MapType, T.VariantType)) or any(map(holds_map, inner))

    return [F.to_json(F.struct(F.col(f"`{f.name}`"))) if holds_map(f.dataType) else F.col(f"`{f.name}`") for f in df.schema.fields]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
