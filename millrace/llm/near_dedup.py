"""MinHash near-dedup with an LSH forest.

Sketch. A document's set holds its distinct word shingles (64-bit hashes). Documents with
equal sets form a class, found by a 128-bit fingerprint; only the class's smallest id goes
on. Its signature is `trees` runs of `depth` min-hash values.

Forest. For each tree all signatures are put in one sorted order, cut by range, so a
crowded region spreads over tasks and gets deeper prefixes by itself. A document's
candidates in a tree are the neighbours before it and the first document of the region
that shares as many leading values with it as its neighbour does: a shallow region where
documents are sparse, a deeper one where they crowd. The first documents of deep regions
meet those of the shallower ones around them in the same way, down to `base` values, so a
region hangs together with a constant number of candidates a document. Regions that go
over a cut are joined by their first documents.

Links. Candidates are confirmed by exact intersection of the full sets. First each
document meets its most frequent candidate; confirmed links give components; then every
candidate pair that still lies between two components is confirmed as well. So no
candidate is dropped, and a group of m near copies costs about m confirmations, not m * m.
Components come from alternating large-star and small-star steps on tables.

Rest. A document may be linked to just one of a crowded region's many, and neighbours miss
that one. So regions that still hold several components are gone through. Whoever is
outside the region's largest component meets that whole component, once however many
regions they share: its members are dealt into blocks of `block`, signatures whose
agreement is more than four standard deviations below the threshold are passed over, and
the others' sets are compared in place, the likeliest first, until their components are
joined; only the links that joined them leave the task. Those outside meet each other in
the same way, block by block. So all that share `base` values are compared, alike at
every size of a region, in bounded tasks; of them, no pair leaves a task but a link that
joins two components. The work in such a region is (those outside) times (its rows).

A pair at similarity s shares a region in some tree with probability
1 - (1 - s**base)**trees: 0.999997 at 0.8 with the defaults.

Defined cases: null, empty and wordless texts have an empty set and link with nothing;
texts of fewer words than a shingle are one shingle; rows that repeat an id are judged
each by its own text; a row without id belongs to the component of its set and is kept
only if no other document has that set; ids are whole numbers, or text of such (anything
else is an error); very long texts are read whole. Only the two named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialise, measure, partitions, pieces, temporary
from .decontaminate import _portions
from .words import SPACED, U64, Words, mix, windows

_PAIR = "a long, b long, edge binary"


def shingle_sets(words: Words, width: int) -> Iterator[np.ndarray]:
    """The distinct shingles of each text, sorted; fewer words than a shingle are one."""
    h = words.hashes
    whole = windows(h, width, 3)
    for a, b in zip(words.first.tolist(), words.first[1:].tolist()):
        if b - a >= width:
            yield np.unique(whole[a : b - width + 1])
        else:
            yield windows(h[a:b], b - a, 3 + (b - a) * 7) if b > a else np.zeros(0, U64)


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    x = mix(np.arange(1, 2 * n + 1, dtype=U64) * U64(0xD1B54A32D192ED03))
    return (x[:n] | U64(1))[:, None], x[n:][:, None]


def signature(shingles: np.ndarray, times: np.ndarray, plus: np.ndarray) -> np.ndarray:
    low = np.full(len(times), np.iinfo(np.uint64).max, dtype=U64)
    for at in range(0, len(shingles), 2048):
        low = np.minimum(low, (shingles[None, at : at + 2048] * times + plus).min(axis=1))
    return (low >> U64(32)).astype(">u4")


def _sketch(docs: DataFrame, width: int, trees: int, depth: int) -> DataFrame:
    times, plus = _permutations(trees * depth)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _portions(batch, 1):
                n, prints, signs = [], [], []
                for s in shingle_sets(Words(part.column(1), SPACED, lower=True), width):
                    n.append(len(s))
                    prints.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    signs.append(signature(s, times, plus).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(prints, pa.binary()), pa.array(signs, pa.binary())], names=["id", "n", "print", "sign"])

    return docs.mapInArrow(sketch, "id long, n long, print binary, sign binary")


def least_agreement(values: int, percent: int) -> float:
    """Fewer equal signature values than this are four standard deviations below the threshold."""
    p = percent / 100
    return values * p - 4 * (values * p * (1 - p)) ** 0.5


def _regions(labelled: DataFrame, trees: int, depth: int, d: int) -> DataFrame:
    """(h, id, comp): each tree's region of d values."""
    rows = [F.struct(F.xxhash64(F.lit(t), F.substring("sign", 4 * depth * t + 1, 4 * d)).alias("h"), "id", "comp") for t in range(trees)]
    return labelled.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def _outsiders(forest: DataFrame) -> DataFrame:
    """(h, id, comp, main, outside): rows of regions with several components that aren't in the largest one there."""
    sizes = forest.groupBy("h", "comp").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("h").agg(F.max_by("comp", F.struct("n", -F.col("comp"))).alias("main"), (F.sum("n") - F.max("n")).alias("outside")).where("outside > 0")
    return forest.join(main, "h").where("comp <> main")


def _blocks_of(members: DataFrame, meets: DataFrame, block: int, mutual: bool) -> tuple[DataFrame, DataFrame, int]:
    """Members of what is to be met (main), and those who meet it, dealt into groups (g) of many cells.

    A cell is a block of members with a block of those who meet them. Where both are the same
    rows (mutual), any two blocks meet in one cell only.
    """
    guests = meets.groupBy("main").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    size = members.select("main").join(guests, "main").groupBy("main", "parts").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"), F.count(F.lit(1)).alias("n"))
    size = materialise(size, "sizes")
    groups = pieces((size.agg(F.sum(F.col("n") * F.col("parts"))).first()[0] or 0) + meets.count(), 1_000)
    deal = F.pmod(F.xxhash64("main", "cell"), F.lit(groups)).cast("int").alias("g")
    share = lambda over: F.pmod(F.xxhash64("id"), F.col(over)).cast("int")
    every = lambda over: F.explode(F.sequence(F.lit(0), F.col(over) - 1))
    cell = F.col("row") * F.col("parts") + F.col("part")
    inner = members.join(size, "main").withColumn("row", share("blocks")).withColumn("part", every("parts"))
    outer = meets.join(size, "main").withColumn("part", share("parts")).withColumn("row", every("blocks"))
    once = F.col("part") <= F.col("row") if mutual else F.lit(True)
    dealt = lambda df: df.where(once).withColumn("cell", cell).select(deal, "main", "cell", "id", "comp")
    return dealt(inner), dealt(outer), groups


def _cells(table: pa.Table, main: str, cell: str) -> dict[tuple[int, int], np.ndarray]:
    rows: dict[tuple[int, int], list[int]] = {}
    for i, key in enumerate(zip(table.column(main).to_pylist(), table.column(cell).to_pylist())):
        rows.setdefault(key, []).append(i)
    return {k: np.array(v) for k, v in rows.items()}


def _signs(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=">u4").astype(np.uint32).reshape(len(column), -1)


def _likely(at: np.ndarray, own: tuple[int, int, np.ndarray], ids: np.ndarray, comp: np.ndarray, signs: np.ndarray, least: float) -> np.ndarray:
    """Of the members at these places, those of other components than own (id, component, signature) that agree enough, the likeliest first."""
    if (ids[at] == own[0]).any():  # a block with itself: each pair once
        at = at[ids[at] > own[0]]
    at = at[comp[at] != own[1]]
    agree = (signs[at] == own[2]).sum(axis=1)
    return at[np.argsort(-agree, kind="stable")][: int((agree >= least).sum())]


def _meet_in_blocks(members: DataFrame, meets: DataFrame, signs: DataFrame, texts: DataFrame, width: int, percent: int, block: int, mutual: bool = False) -> DataFrame:
    """Links (a, b) between (id, comp, main) of meets and of members with the same main: in each task enough to join all components that are linked there."""
    members, outer, groups = _blocks_of(members, meets, block, mutual)

    def screen(left: pa.Table, right: pa.Table) -> pa.Table:
        """Who has a partner at all."""
        out: dict[tuple[int, int, int, int, bool], None] = {}
        if left.num_rows and right.num_rows:
            mine, theirs, cells = _signs(left.column("osign")), _signs(right.column("sign")), _cells(right, "main", "cell")
            ids, comp, least = right.column("id").to_numpy(), right.column("comp").to_numpy(), least_agreement(theirs.shape[1], percent)
            for i, (m, c, x, k) in enumerate(zip(*(left.column(k).to_pylist() for k in ("omain", "ocell", "oid", "ocomp")))):
                at = _likely(cells.get((m, c), np.zeros(0, np.int64)), (x, k, mine[i]), ids, comp, theirs, least)
                if len(at):
                    out[m, c, x, k, True] = None
                    out.update(dict.fromkeys((m, c, *y, False) for y in zip(ids[at].tolist(), comp[at].tolist())))
        columns = list(zip(*out)) or [()] * 5
        return pa.table({"main": pa.array(columns[0], pa.int64()), "cell": pa.array(columns[1], pa.int32()), "id": pa.array(columns[2], pa.int64()), "comp": pa.array(columns[3], pa.int64()), "outer": pa.array(columns[4], pa.bool_())})

    aside = lambda df, *more: df.select(F.col("g").alias("g"), *[F.col(c).alias(f"o{c}") for c in ("main", "cell", "id", "comp", "sign", *more)])
    left = aside(outer.join(signs, "id")).repartition(partitions(groups), "g").groupBy("g")
    right = members.join(signs, "id").repartition(partitions(groups), "g").groupBy("g")
    some = materialise(left.cogroup(right).applyInArrow(screen, "main long, cell int, id long, comp long, outer boolean"), "screened")
    groups = pieces(some.count(), 250)
    full = some.join(texts, "id").join(signs, "id").withColumn("g", F.pmod(F.xxhash64("main", "cell"), F.lit(groups)).cast("int"))

    def confirm(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = [], []
        if left.num_rows and right.num_rows:
            mine, theirs, cells = _signs(left.column("osign")), _signs(right.column("sign")), _cells(right, "main", "cell")
            ids, least = right.column("id").to_numpy(), least_agreement(theirs.shape[1], percent)
            comp, own = right.column("comp").to_numpy().copy(), left.column("ocomp").to_numpy().copy()  # as joined by the links found here
            sets = list(_sets(right, "text", width))
            for i, (m, c, x, s) in enumerate(zip(*(left.column(k).to_pylist() for k in ("omain", "ocell", "oid")), _sets(left, "otext", width))):
                at = _likely(cells.get((m, c), np.zeros(0, np.int64)), (x, own[i], mine[i]), ids, comp, theirs, least)
                while len(at):
                    j, at = at[0], at[1:]
                    if _linked(s, sets[j], percent):
                        a.append(min(x, int(ids[j])))
                        b.append(max(x, int(ids[j])))
                        joined = comp[j]
                        comp[comp == joined], own[own == joined] = own[i], own[i]
                        at = at[comp[at] != own[i]]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    left = aside(full.where("outer"), "text").repartition(partitions(groups), "g").groupBy("g")
    right = full.where("NOT outer").select("g", "main", "cell", "id", "comp", "sign", "text").repartition(partitions(groups), "g").groupBy("g")
    return left.cogroup(right).applyInArrow(confirm, "a long, b long")


def _crowded(labelled: DataFrame, texts: DataFrame, trees: int, depth: int, base: int, percent: int, width: int, block: int) -> DataFrame:
    """Links found where a region still holds several components: all that lie outside its largest one meet that, and each other."""
    signs = labelled.select("id", "sign")
    forest = materialise(_regions(labelled, trees, depth, base), "regions")
    outside = materialise(_outsiders(forest), "outside")
    meets = materialise(outside.select("id", "comp", "main").distinct(), "meets")
    links = _meet_in_blocks(labelled.select("id", "comp", F.col("comp").alias("main")), meets, signs, texts, width, percent, block)
    each = materialise(outside.where("outside > 1").select("id", "comp", F.col("h").alias("main")).distinct(), "each")
    return links.unionByName(_meet_in_blocks(each, each, signs, texts, width, percent, block, mutual=True))


def _neighbours(depth: int, base: int, before: int):
    """Candidate pairs from one range of a sorted order of (tree, key, id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None  # of the rows so far: the last `before`, and the first of the region at each depth
        opening, closing = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            tree = batch.column(0).to_numpy().astype(np.int64)
            key = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=">u4").reshape(-1, depth)
            ids = batch.column(2).to_numpy()
            own = len(ids)
            leaders = np.zeros((0, depth + 1), np.int64)
            if tail is not None:
                tree, key, ids = np.concatenate((tail[0], tree)), np.concatenate((tail[1], key)), np.concatenate((tail[2], ids))
                leaders = tail[3]
            old = len(ids) - own
            same = np.zeros(len(ids), np.int64)  # values shared with the row before
            equal = (key[1:] == key[:-1]) & (tree[1:] == tree[:-1])[:, None]
            same[1:] = np.cumprod(equal, axis=1).sum(axis=1)
            pairs = []
            shared = same.copy()
            for j in range(1, before + 1):
                at = np.arange(max(j, old), len(ids))
                if j > 1:
                    shared[j:] = np.minimum(shared[j:], same[1 : len(ids) - j + 1])
                at = at[shared[at] >= base]
                pairs.append((ids[at - j], ids[at]))
            lead = np.zeros((len(ids), depth + 1), np.int64)
            for d in range(base, depth + 1):
                begin = np.where(same >= d, 0, np.arange(len(ids)))
                first = ids[np.maximum.accumulate(begin)]
                if old:  # regions that began in an earlier batch
                    going = np.maximum.accumulate(begin) < old
                    going[old:] &= np.minimum.accumulate(np.where(same[old:] >= d, 1, 0)).astype(bool)
                    first = np.where(going, leaders[-1, d], first)
                lead[:, d] = first
                new = np.arange(old, len(ids))
                new = new[(same[new] == d) & (first[new] != ids[new])]
                pairs.append((first[new], ids[new]))
            if opening is None:
                opening = (tree[0], key[0, :base].tobytes(), lead[0, base])
            closing = (tree[-1], key[-1, :base].tobytes(), lead[-1, base])
            tail = tuple(x[-before:] for x in (tree, key, ids, lead))
            a, b = (np.concatenate(x) for x in zip(*pairs))
            low, high = np.minimum(a, b), np.maximum(a, b)
            low, high = low[low != high], high[low != high]
            yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high), pa.nulls(len(low), pa.binary())], names=["a", "b", "edge"])
        if opening is not None:
            for t, prefix, leader in {opening, closing}:
                yield pa.RecordBatch.from_arrays([pa.array([leader]), pa.array([leader]), pa.array([int(t).to_bytes(2, "big") + prefix], pa.binary())], names=["a", "b", "edge"])

    return run


def _candidates(reps: DataFrame, rows: int, trees: int, depth: int, base: int, before: int) -> DataFrame:
    """a < b, with the number of times that the forest proposes the pair."""
    width = 4 * depth
    keys = reps.select(F.explode(F.array(*[F.struct(F.lit(t).alias("tree"), F.substring("sign", t * width + 1, width).alias("key"), "id") for t in range(trees)])).alias("x")).select("x.*")
    cuts = partitions(pieces(rows * trees, 200_000))
    ordered = keys.repartitionByRange(cuts, "tree", "key", "id").sortWithinPartitions("tree", "key", "id")
    found = materialise(ordered.mapInArrow(_neighbours(depth, base, before), _PAIR), "forest")
    edges = found.where("edge is not null").select("edge", F.col("a").alias("id")).distinct()
    first = edges.groupBy("edge").agg(F.min("id").alias("a"))
    over = edges.join(first, "edge").where("id > a").select("a", F.col("id").alias("b"))
    inside = found.where("edge is null").select("a", "b")
    return inside.unionByName(over).groupBy("a", "b").agg(F.count(F.lit(1)).alias("times"))


def _confirm(pairs: DataFrame, texts: DataFrame, width: int, percent: int, groups: int, most: int = 256) -> DataFrame:
    """The pairs whose full sets meet the threshold. A hub with many partners is served in several groups.

    The end with more partners is the hub, whichever of the two that is.
    """
    # Only ends with more than `most` partners matter here; they are few, and joined by broadcast while their table is small.
    both = pairs.select(F.col("a").alias("x")).unionByName(pairs.select(F.col("b").alias("x"))).groupBy("x").agg(F.count(F.lit(1)).alias("k"))
    many = materialise(both.where(F.col("k") > most), "hubs")
    pairs = pairs.join(many.toDF("a", "ka"), "a", "left").join(many.toDF("b", "kb"), "b", "left")
    turned = F.coalesce("kb", F.lit(0)) > F.coalesce("ka", F.lit(0))
    pairs = pairs.select(F.when(turned, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(turned, F.col("a")).otherwise(F.col("b")).alias("b"))
    parts = many.select(F.col("x").alias("a"), F.ceil(F.col("k") / most).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("b"), F.coalesce("parts", F.lit(1))).cast("int")
    salted = materialise(pairs.join(parts, "a", "left").select("a", "b", part.alias("part")), "pairs")
    group = F.pmod(F.xxhash64("a", "part"), F.lit(groups)).cast("int").alias("g")
    partners = salted.join(texts.withColumnRenamed("id", "b"), "b").select(group, "a", "part", "b", "text")
    served = salted.select("a", "part").distinct().join(texts.withColumnRenamed("id", "a"), "a")
    # New names: both sides come from the same tables.
    served = served.select(group, F.col("a").alias("hub"), F.col("part").alias("hub_part"), F.col("text").alias("hub_text"))

    def check(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = [], []
        hubs: dict[tuple[int, int], list[np.ndarray]] = {}
        for key, s in zip(zip(right.column("hub").to_pylist(), right.column("hub_part").to_pylist()), _sets(right, "hub_text", width)):
            hubs.setdefault(key, []).append(s)
        for x, part, y, s in zip(left.column("a").to_pylist(), left.column("part").to_pylist(), left.column("b").to_pylist(), _sets(left, "text", width)):
            if any(_linked(s, hub, percent) for hub in hubs.get((x, part), ())):
                a.append(min(x, y))
                b.append(max(x, y))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    left, right = partners.repartition(partitions(groups), "g"), served.repartition(partitions(groups), "g")
    return left.groupBy("g").cogroup(right.groupBy("g")).applyInArrow(check, "a long, b long")


def _sets(table: pa.Table, column: str, width: int) -> Iterator[np.ndarray]:
    for batch in table.to_batches():
        for part in _portions(batch, batch.schema.get_field_index(column)):
            yield from shingle_sets(Words(part.column(column), SPACED, lower=True), width)


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)) or not len(x) or not len(y):
        return False
    common = len(x) + len(y) - len(np.union1d(x, y))
    return 100 * common >= percent * (len(x) + len(y) - common)


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id in links (a, b): root is the smallest id reachable, ids that are roots are left out."""
    stars = materialise(links.select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).where("x > y").distinct(), "links")
    while not stars.join(stars.select(F.col("y").alias("x")).distinct(), "x", "left_semi").isEmpty() or stars.count() > stars.select("x").distinct().count():
        both = stars.unionByName(stars.select(F.col("y").alias("x"), F.col("x").alias("y")))
        low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.join(low, "x").where("y > x").select(F.col("y").alias("x"), F.col("m").alias("y")).where("x > y").distinct()
        least = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(least, "x").where("y > m").select(F.col("y").alias("x"), F.col("m").alias("y"))
        stars = materialise(least.select("x", F.col("m").alias("y")).unionByName(small).distinct(), "stars")
    return stars.select(F.col("x").alias("id"), F.col("y").alias("root"))


def tree_roots(parents: DataFrame) -> DataFrame:
    """(id, root) of links (a, b) where each b has one a below it: everyone points twice as far until all point at roots."""
    roots = materialise(parents.select(F.col("b").alias("id"), F.col("a").alias("root")), "roots")
    while True:
        up = roots.select(F.col("id").alias("root"), F.col("root").alias("above"))
        roots = materialise(roots.join(up, "root", "left").select("id", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), "roots")
        if roots.where("moved").isEmpty():
            return roots.select("id", "root")
        roots = roots.select("id", "root")


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(id, root) with more links: components of the roots alone, carried over to their members."""
    across = materialise(_between(links, roots, keep_roots=True), "across")
    if across.isEmpty():
        return roots
    above = components(across)
    moved = roots.join(above.select(F.col("id").alias("root"), F.col("root").alias("above")), "root", "left").select("id", F.coalesce("above", "root").alias("root"))
    return materialise(moved.unionByName(above), "roots")


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    trees: int = 24,
    depth: int = 6,
    base: int = 4,
    before: int = 1,
    block: int = 512,
) -> DataFrame:
    """id, n_shingles, component_id (smallest id reachable over links of percent similarity or more) and kept."""
    bounded_batches(docs.sparkSession)
    with temporary(docs.sparkSession):  # all but what the result reads goes at the end
        source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
        sketches = materialise(_sketch(source, shingle_words, trees, depth), "sketch", keep=True)
        classes = sketches.where("n > 0 and id is not null").groupBy("print").agg(F.min(F.struct("id", "sign")).alias("m"))
        reps = materialise(classes.select("print", "m.id", "m.sign"), "classes", keep=True)
        count = reps.count()
        pairs = materialise(_candidates(reps, count, trees, depth, base, before), "pairs")
        # Whoever shares a region with anyone is in some pair; all later steps stay among these. Always joined by
        # shuffle: they grow with the corpus.
        ids = materialise(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct(), "ids").hint("shuffle_hash")
        texts = materialise(source.join(ids, "id", "left_semi"), "texts")
        near = reps.select("id", "sign").join(ids, "id", "left_semi")
        groups = pieces(2 * measure(texts, "text")[1], 4 << 20)

        def confirmed(asked: DataFrame) -> DataFrame:
            return materialise(_confirm(materialise(asked.select("a", "b"), "asked"), texts, shingle_words, percent, groups), "links")

        best = pairs.groupBy("b").agg(F.max_by("a", F.struct("times", -F.col("a"))).alias("a")).select("a", "b")
        roots = tree_roots(confirmed(best))
        roots = merged(roots, confirmed(_between(pairs, roots).join(best, ["a", "b"], "left_anti")))
        labelled = materialise(near.join(roots, "id", "left").select("id", "sign", F.coalesce("root", "id").alias("comp")), "labelled")
        roots = merged(roots, materialise(_crowded(labelled, texts, trees, depth, base, percent, shingle_words, block), "links"))
        roots = materialise(roots, "roots", keep=True)

    labels = reps.select("print", "id").join(roots, "id", "left").select("print", F.coalesce("root", "id").alias("root"))
    found = sketches.select("id", "n", "print").join(labels, "print", "left")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("root"))
    out = found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.col("component_id").isNull()))


def _between(pairs: DataFrame, roots: DataFrame, keep_roots: bool = False) -> DataFrame:
    """Pairs whose ends lie in different components; as those components if keep_roots."""
    end = lambda side: roots.select(F.col("id").alias(side), F.col("root").alias(f"root_{side}"))
    joined = pairs.join(end("a"), "a", "left").join(end("b"), "b", "left")
    ends = joined.select("a", "b", F.coalesce("root_a", "a").alias("x"), F.coalesce("root_b", "b").alias("y")).where("x <> y")
    return ends.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct() if keep_roots else ends.select("a", "b")
