"""Line dedup: drop lines that many documents share, keep them once.

Lines are exploded as (document, 128-bit hash of the normalised line), one row for each
document and distinct key, so the count of a key is its count of documents. Partial
aggregation sends at most one row per key and task, however common a line is. The keys
over the threshold are joined back to the exploded lines, which gives the positions to
drop. These are gathered for each text, and the text is put together again from the
positions that stay, in their order: the work on a text grows with its lines alone, not
with lines times drops.

Defined cases: a null or empty text is one empty line, which stays; ids identify
documents, and rows that repeat an id count as one document and are judged alike; a null
id counts as one document too. Texts are told apart by id and 128-bit hash. Extra input
columns are carried along, whatever their names; columns named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import apart, materialise

OUTPUTS = ("n_lines", "n_dropped", "kept_text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit("\t\n\x0b\x0c\r "))
    # lower() is the same on ASCII, and cheaper.
    return F.when(F.length(bare) == F.octet_length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def _hash(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit("line"), key).alias("b"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """docs with n_lines, n_dropped and kept_text.

    A key of min_chars code points or more in min_docs documents or more loses all its
    lines except those of the largest id that holds it.
    """
    ident, text = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lines = F.split(text, "\n", -1)
    # Each step of these arrays is computed once: key, then hash; short lines have no hash.
    hashes = F.transform(F.transform(lines, line_key), lambda k: F.when(F.length(k) >= min_chars, _hash(k)))
    which = [ident.alias("id"), F.xxhash64(text).alias("t"), F.xxhash64(F.lit("text"), text).alias("u")]
    # Hashed before lines are exploded: once a text. Written, as counts and positions both read it.
    texts = docs.select(*which, hashes.alias("hashes"))
    placed = materialise(texts.select("id", "t", "u", F.posexplode("hashes").alias("pos", "h")).where("h is not null"), "lines")
    seen = placed.select("id", "h").distinct()
    common = (
        seen.groupBy("h")
        .agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keeper"))
        .where(F.col("n") >= min_docs)
        .select("h", "keeper")
    )
    drops = seen.join(common, "h").where(~F.col("id").eqNullSafe(F.col("keeper"))).select(F.col("id").alias("d_id"), F.col("h").alias("d_h"))
    # A set: rows alike in id and text add nothing to one another, however many they are.
    gone = (
        placed.join(drops, F.col("id").eqNullSafe(F.col("d_id")) & (F.col("h") == F.col("d_h")), "left_semi")
        .groupBy("id", "t", "u")
        .agg(F.collect_set("pos").alias("gone"))
    )
    at_id, at_t, at_u, at_gone, at_lines, at_kept = apart(docs, "__id", "__t", "__u", "__gone", "__lines", "__kept")
    gone = gone.toDF(at_id, at_t, at_u, at_gone)
    same = ident.eqNullSafe(F.col(at_id)) & (F.xxhash64(text) == F.col(at_t)) & (F.xxhash64(F.lit("text"), text) == F.col(at_u))
    joined = docs.join(gone, same, "left").withColumn(at_lines, lines)
    line = lambda i: F.get(F.col(at_lines), i)
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(at_lines) - 1), F.col(at_gone)), line)
    joined = joined.withColumn(at_kept, F.when(F.col(at_gone).isNull(), F.col(at_lines)).otherwise(kept))
    n_lines = F.size(at_lines).cast("long")
    return joined.select(
        *[F.col(f"`{c}`") for c in docs.columns if c.lower() not in OUTPUTS],
        n_lines.alias("n_lines"),
        (n_lines - F.size(at_kept)).alias("n_dropped"),
        F.array_join(at_kept, "\n").alias("kept_text"),
    )
