"""Mixing sources to target weights by Pareto order sampling.

Targets: sources in code point order (null last) take the weights in turn and share
`share` times all words; a target stops at `most` times its source's words and what is
over is shared again by weight. A source whose target is f times its words gets
floor(f) whole copies of each document for certain. The rest is a sample of unequal
probabilities: a document's inclusion odds p / (1 - p) are proportional to its weight.
Documents are ranked by random odds divided by inclusion odds, (u / (1 - u)) / weight (a
source's common factor changes no order), and taken from the smallest on until the words
still wanted are met as closely as whole documents allow, which fixes the factor. So p
stays below one whatever the weights, and no probability has to be cut off.

The weight is weight_col where one is given. Otherwise it is size / (size + half_words):
very short documents are the less likely to be taken, one of half_words words half as
likely (in odds) as a very long one. u comes from a hash of the id, so reruns agree.

The cut in each source's order is found without sorting the source: a histogram of the
ranks (one row for each source and bin) gives the bin that holds the cut; the documents
of that bin alone are binned again, three times in all, and those of the last bin are
ordered. All of it are grouped aggregates and windows over a source's bins, so no task
holds a source and the driver sees totals over all sources alone. The table of sources is
broadcast while it has at most BROADCAST_SOURCES rows, and joined like any other beyond.

Defined cases: a null text has size 0; null is a source of its own; documents without id
draw from their text; rows with equal rank and id are taken or left together; a document
of weight zero, below zero, null or not a number is not sampled (its whole copies stay);
a source without words has target 0; a very long text is one document. Extra columns are
carried, whatever their names; columns named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACE_WORD, apart, materialise, pieces, temporary, without

BROADCAST_SOURCES = 100_000
OUTPUTS = ("size", "source_size", "target", "copies", "taken")


def numbered(sources: DataFrame) -> DataFrame:
    """Sources (s, n) with their place in code point order, null last; ranges of the order are counted apart."""
    parts = pieces(sources.count(), 100_000)
    order = [F.col("s").isNull(), F.col("s")]
    ranged = materialise(sources.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "sources")
    ranged = ranged.withColumn("i", F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1)
    # One row for each range.
    before = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("k")).withColumn("before", F.sum("k").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    return ranged.join(F.broadcast(before), "part").select("s", "n", (F.col("i") + F.coalesce("before", F.lit(0))).alias("place"))


def allocate(sources: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Sources (s, n) with their target words. Each round of sharing is one pass over the sources."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    held = materialise(numbered(sources).select("s", "n", weight.alias("w"), (F.lit(float(most)) * F.col("n")).alias("cap")), "sources")
    total = held.agg(F.sum("n")).first()[0] or 0
    full, known, rest, each = F.lit(False), 0, share * total, 0.0
    while True:
        row = held.agg(F.count_if(full).alias("k"), F.sum(F.when(full, F.col("cap"))).alias("cap"), F.sum(F.when(~full, F.col("w"))).alias("w")).first()
        rest, each = share * total - (row.cap or 0.0), row.w or 1.0
        if known and row.k == known[0]:
            break
        known = (row.k,)
        full = full | (F.lit(rest) * F.col("w") / F.lit(each) > F.col("cap"))
    return held.select("s", "n", F.when(full, F.col("cap")).otherwise(F.lit(rest) * F.col("w") / F.lit(each)).alias("target"))


def _draw(id_col: Column, text: Column, seed: str) -> Column:
    hexes = F.md5(F.concat(F.lit(seed), F.coalesce(id_col.cast("string"), text, F.lit(""))))
    return (F.conv(F.substring(hexes, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def mix_sources(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix:",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weight_col: str | None = None,
    half_words: int = 100,
    bins: int = 1024,
) -> DataFrame:
    """docs with size, source_size, target, copies and taken (= copies * size)."""
    docs = without(docs, *OUTPUTS)
    size = F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(SPACE_WORD)), F.lit(0)).cast("long")
    u = _draw(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), seed)
    tie = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))

    def rank(n: Column, u: Column) -> Column:
        """Random odds over inclusion odds; none where a document is not to be sampled."""
        weight = F.col(f"`{weight_col}`").cast("double") if weight_col else n / (n + F.lit(float(half_words)))
        weight = F.when(~F.isnan(weight) & (weight > 0), weight)
        return u / (1 - u) / weight

    with temporary(docs.sparkSession):
        keys = docs.select(F.col(f"`{source_col}`").alias("s"), size.alias("n"), rank(size, u).alias("q"), tie.alias("tie"))
        # Rows with equal rank and id count as one: they are taken or left together.
        keys = materialise(keys.groupBy("s", "q", "tie").agg(F.sum("n").alias("n")), "mix")
        targets = allocate(keys.groupBy("s").agg(F.sum("n").alias("n")), weights, share, most)
        whole = F.when(F.col("n") > 0, F.floor(F.col("target") / F.col("n"))).otherwise(0).cast("int")
        goals = materialise(targets.withColumn("whole", whole).withColumn("want", F.col("target") - F.col("whole") * F.col("n")), "goals")
        # Tables of one row for each source: broadcast while they are few, joined like any other beyond that.
        small = F.broadcast if goals.count() <= BROADCAST_SOURCES else lambda df: df
        cuts = cut_points(keys.where("q is not null"), goals.where("want > 0").select("s", "want"), bins, small)
        limits = goals.join(cuts, goals.s.eqNullSafe(cuts.cut_s), "left").drop("cut_s", "want")
        limits = materialise(limits, "limits", keep=True)

    names = dict(zip(limits.columns, apart(docs, *[f"__{c}" for c in limits.columns])))
    at_size, at_u, at_q, at_tie, at_copies = apart(docs, "__size", "__u", "__q", "__key", "__copies")
    at = {k: F.col(v) for k, v in names.items()}
    full = docs.withColumns({at_size: size, at_u: u, at_tie: tie}).withColumn(at_q, rank(F.col(at_size), F.col(at_u)))
    full = full.join(small(limits.withColumnsRenamed(names)), F.col(f"`{source_col}`").eqNullSafe(at["s"]), "left")
    q = F.col(at_q)
    more = (_line(q) < at["low"]) | (q < at["cut_q"]) | ((q == at["cut_q"]) & (F.col(at_tie) <= at["cut_tie"]))
    full = full.withColumn(at_copies, at["whole"] + F.when(F.coalesce(more, F.lit(False)), 1).otherwise(0))
    return full.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.col(at_size).alias("size"),
        at["n"].alias("source_size"),
        at["target"].alias("target"),
        F.col(at_copies).alias("copies"),
        (F.col(at_copies) * F.col(at_size)).cast("long").alias("taken"),
    )


def _line(q: Column) -> Column:
    """Ranks carried from (0, inf) to (0, 1), in order."""
    return q / (1 + q)


def cut_points(keys: DataFrame, goals: DataFrame, bins: int, small) -> DataFrame:
    """(cut_s, low, cut_q, cut_tie): all below low are taken, and from there to the last document (cut_q, cut_tie); no such one where none is."""
    inside = keys.select("s", "n", "q", "tie", _line(F.col("q")).alias("z"))
    state = goals.select("s", F.lit(0.0).alias("low"), F.lit(1.0).alias("width"), "want")
    for _ in range(3):
        open_ = small(state.withColumnRenamed("s", "o_s"))
        binned = inside.select("s", "n", "q", "tie", "z").join(open_, F.col("s").eqNullSafe(F.col("o_s"))).drop("o_s")
        b = F.greatest(F.least(F.floor((F.col("z") - F.col("low")) / F.col("width") * bins), F.lit(bins - 1)), F.lit(0)).cast("int")
        binned = binned.withColumn("b", b)
        # At most `bins` rows of a source meet in this window.
        hist = binned.groupBy("s", "low", "width", "want", "b").agg(F.sum("n").alias("k")).withColumn("cum", F.sum("k").over(Window.partitionBy("s").orderBy("b")))
        here = F.struct("b", (F.col("cum") - F.col("k")).alias("before"))
        found = hist.groupBy("s", "low", "width", "want").agg(F.coalesce(F.min(F.when(F.col("cum") >= F.col("want"), here)), F.max(here)).alias("m"))
        found = materialise(found.select("s", "low", "width", F.col("m.b").alias("at"), (F.col("want") - F.col("m.before")).alias("want")), "bins")
        chosen = small(found.select(F.col("s").alias("c_s"), "at"))
        inside = binned.join(chosen, F.col("s").eqNullSafe(F.col("c_s")) & (F.col("b") == F.col("at"))).select("s", "n", "q", "tie", "z")
        inside = materialise(inside, "inside")
        state = found.select("s", (F.col("low") + F.col("width") * F.col("at") / bins).alias("low"), (F.col("width") / bins).alias("width"), "want")
    # The last bin alone is ordered; one row before it stands for "nothing of this bin".
    nothing = state.select("s", F.lit(0).cast("long").alias("n"), F.lit(float("-inf")).alias("q"), F.lit("").alias("tie"))
    order = Window.partitionBy("s").orderBy("q", "tie")
    ladder = inside.select("s", "n", "q", "tie").unionByName(nothing).withColumn("cum", F.sum("n").over(order))
    goal = small(state.select(F.col("s").alias("g_s"), "low", "want"))
    ladder = ladder.join(goal, F.col("s").eqNullSafe(F.col("g_s")))
    best = ladder.groupBy("s", "low").agg(F.min(F.struct(F.abs(F.col("cum") - F.col("want")).alias("gap"), "q", "tie")).alias("m"))
    return best.select(F.col("s").alias("cut_s"), "low", F.col("m.q").alias("cut_q"), F.col("m.tie").alias("cut_tie"))


def expand_copies(mixed: DataFrame) -> DataFrame:
    """One row for each copy taken."""
    copy = apart(mixed, "__copy")[0]
    return mixed.where("copies > 0").withColumn(copy, F.explode(F.sequence(F.lit(1), F.col("copies")))).drop(copy)
