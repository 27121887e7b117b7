"""Substring dedup by fixed-block anchors.

Every repeat of `window` words holds, in each of its occurrences, a whole aligned block
of (window + 1) // 2 words. So the index holds the non-overlapping blocks of all
documents, and every rolling window of a block's length probes it. A block found in
another place too is an anchor. Hits are extended to exact repeats: all full windows
around an anchor are compared, corpus-wide, by their 64-bit fingerprints, and windows
that occur again fuse into maximal spans. Spans, not pairs, come out: the work is linear
however many places share a passage.

Layout. Documents are dealt by hash into batches of bounded bytes; that exchange is
written once and read by three steps. A batch sends each of its distinct hashes once, in
sorted blocks for hash ranges ("buckets"), so a passage in a third of all documents costs
one entry for each batch. A bucket answers with one bit for each entry. Hashes in an
anchor message are 32 bits next to the bucket number; chance hits among them only send
more windows to the second, full-width comparison, which decides.

Equality is by 64-bit polynomial fingerprints within a bucket of a hash range.

Defined cases: a null or empty text has no words; nothing is removed from texts shorter
than the window; repeated rows are places of their own, so they remove each other; ids
are only carried. The result has exactly the columns id, n_words, n_removed, kept_text
and spans, whatever else the input holds.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, measure, partitions, pieces, row_hash
from .words import SPACED, Words, cover, spans, windows

_MESSAGE = "bucket int, batch int, kind int, hashes binary, flags binary"
_ANSWER = "batch int, bucket int, kind int, bits binary"
_MSG = pa.schema([("bucket", pa.int32()), ("batch", pa.int32()), ("kind", pa.int32()), ("hashes", pa.binary()), ("flags", pa.binary())])
_ANS = pa.schema([("batch", pa.int32()), ("bucket", pa.int32()), ("kind", pa.int32()), ("bits", pa.binary())])
ANCHOR, WINDOW = 0, 1


def _narrow(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket number and 32 more bits, in one sortable number."""
    top = (hashes >> np.uint64(32)) % np.uint64(buckets)
    return (top << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))


def _bucket(values: np.ndarray, buckets: int, kind: int) -> np.ndarray:
    high = values >> np.uint64(32)
    return high if kind == ANCHOR else (high * np.uint64(buckets)) >> np.uint64(32)


def _cuts(distinct: np.ndarray, buckets: int, kind: int) -> np.ndarray:
    """Where each bucket's part of the sorted values begins; one more at the end."""
    return np.searchsorted(_bucket(distinct, buckets, kind), np.arange(buckets + 1, dtype=np.uint64))


class _Batch:
    """One batch's hashes; built again, alike, in every step."""

    def __init__(self, docs: pa.Table, window: int, buckets: int):
        self.words = Words(docs.column("text"), SPACED, lower=False)
        self.window, self.block, self.buckets = window, (window + 1) // 2, buckets
        h, stop = self.words.hashes, self.words.stop
        probes = windows(h, self.block, 1)
        place = np.arange(len(probes))
        self.probe_at = place[place + self.block <= stop[: len(place)]]
        self.probes = _narrow(probes[self.probe_at], buckets)
        own = self.probe_at - np.repeat(self.words.first[:-1], self.words.counts)[self.probe_at]
        self.is_block = own % self.block == 0
        self.full_hashes = windows(h, window, 2)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct probes, with: seen twice here; in the index."""
        values, inverse, counts = np.unique(self.probes, return_inverse=True, return_counts=True)
        self.inverse = inverse
        indexed = np.zeros(len(values), dtype=bool)
        indexed[inverse[self.is_block]] = True
        return values, counts > 1, indexed

    def candidates(self, hit: np.ndarray) -> np.ndarray:
        """First words of full windows whose aligned block is an anchor."""
        n, first = len(self.words), np.repeat(self.words.first[:-1], self.words.counts)
        anchored = np.zeros(n + self.block, dtype=bool)
        anchored[self.probe_at[hit[self.inverse] & self.is_block]] = True
        place = np.arange(len(self.full_hashes))
        inside = place[place + self.window <= self.words.stop[: len(place)]]
        aligned = inside + (first[inside] - inside) % self.block
        return inside[anchored[aligned]]


def _messages(batch: int, kind: int, values: np.ndarray, flags: list[np.ndarray], buckets: int) -> pa.Table:
    cuts = _cuts(values, buckets, kind)
    out: dict[str, list] = {k: [] for k in _MSG.names}
    for b in np.flatnonzero(np.diff(cuts)):
        part = slice(cuts[b], cuts[b + 1])
        v = values[part].astype(np.uint32) if kind == ANCHOR else values[part]
        for k, x in zip(_MSG.names, (int(b), batch, kind, v.tobytes(), b"".join(np.packbits(f[part]).tobytes() for f in flags))):
            out[k].append(x)
    return pa.table(out, schema=_MSG)


def _match(msgs: pa.Table) -> pa.Table:
    """In one bucket: the bit says that a value occurs twice or more (anchors: and that it is in the index)."""
    kind = msgs.column("kind")[0].as_py()
    each = [np.frombuffer(x, dtype=np.uint32 if kind == ANCHOR else np.uint64) for x in msgs.column("hashes").to_pylist()]
    flags = []
    for x, f in zip(each, msgs.column("flags").to_pylist()):
        bits = np.frombuffer(f, dtype=np.uint8).reshape(2 if kind == ANCHOR else 1, -1)
        flags.append(np.unpackbits(bits, axis=1)[:, : len(x)].astype(bool))
    values, inverse = np.unique(np.concatenate(each), return_inverse=True)
    twice = np.bincount(inverse, minlength=len(values)) > 1
    several = np.concatenate([f[0] for f in flags])
    twice[inverse[several]] = True
    if kind == ANCHOR:
        indexed = np.zeros(len(values), dtype=bool)
        indexed[inverse[np.concatenate([f[1] for f in flags])]] = True
        twice &= indexed
    answer = np.split(twice[inverse], np.cumsum([len(x) for x in each])[:-1])
    return pa.table({"batch": msgs.column("batch"), "bucket": msgs.column("bucket"), "kind": msgs.column("kind"), "bits": pa.array([np.packbits(a).tobytes() for a in answer], pa.binary())}).cast(_ANS)


def _bits(answers: pa.Table, kind: int, values: np.ndarray, buckets: int) -> np.ndarray:
    out = np.zeros(len(values), dtype=bool)
    cuts = _cuts(values, buckets, kind)
    for k, b, bits in zip(*(answers.column(c).to_pylist() for c in ("kind", "bucket", "bits"))):
        if k == kind:
            out[cuts[b] : cuts[b + 1]] = np.unpackbits(np.frombuffer(bits, dtype=np.uint8))[: cuts[b + 1] - cuts[b]]
    return out


def dedup_substrings(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int | None = None) -> DataFrame:
    """id, n_words, n_removed, kept_text (kept words joined by a space), spans (removed words, from 0, end exclusive)."""
    bounded_batches(docs.sparkSession)
    _, size = measure(docs, text_col)
    # Batches grow from 4 to 32 MB with the corpus, so messages keep their length; partitions hold several in the end.
    batches = buckets = pieces(size, batch_bytes or min(32 << 20, max(4 << 20, size >> 12)))
    parts = partitions(batches)
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    dealt = source.withColumn("batch", F.pmod(row_hash("id", F.xxhash64("text")), F.lit(batches)).cast("int")).repartition(parts, "batch")

    def probe(docs: pa.Table) -> pa.Table:
        values, several, indexed = _Batch(docs, window, buckets).anchors()
        return _messages(docs.column("batch")[0].as_py(), ANCHOR, values, [several, indexed], buckets)

    def extend(docs: pa.Table, answers: pa.Table) -> pa.Table:
        batch = _Batch(docs, window, buckets)
        at = batch.candidates(_bits(answers, ANCHOR, batch.anchors()[0], buckets))
        values, counts = np.unique(batch.full_hashes[at], return_counts=True)
        return _messages(docs.column("batch")[0].as_py(), WINDOW, values, [counts > 1], buckets)

    id_type = source.schema["id"].dataType
    schema = f"id {id_type.simpleString()}, n_words long, n_removed long, kept_text string, spans array<struct<first_word:long,end_word:long>>"

    def remove(docs: pa.Table, answers: pa.Table) -> pa.Table:
        batch = _Batch(docs, window, buckets)
        out: dict[str, list] = {"n_removed": [], "kept_text": [], "spans": []}
        at = batch.candidates(_bits(answers, ANCHOR, batch.anchors()[0], buckets))
        values, inverse = np.unique(batch.full_hashes[at], return_inverse=True)
        repeated = at[_bits(answers, WINDOW, values, buckets)[inverse]]
        gone = cover(repeated, window, len(batch.words))
        first = batch.words.first
        total = np.concatenate(([0], np.cumsum(gone)))[first]
        for i, n in enumerate(np.diff(total)):
            words = batch.words.text(i).split()
            if n:
                mine = gone[first[i] : first[i + 1]]
                words = compress(words, ~mine)
                out["spans"].append([{"first_word": a, "end_word": b} for a, b in zip(*(x.tolist() for x in spans(mine)))])
            else:
                out["spans"].append([])
            out["kept_text"].append(b" ".join(words).decode())
            out["n_removed"].append(int(n))
        return pa.table({"id": docs.column("id"), "n_words": pa.array(batch.words.counts, pa.int64()), "n_removed": pa.array(out["n_removed"], pa.int64()), "kept_text": pa.array(out["kept_text"], pa.string()), "spans": pa.array(out["spans"], _SPANS)})

    def answered(messages: DataFrame) -> DataFrame:
        return messages.repartition(parts, "bucket").groupBy("bucket").applyInArrow(_match, _ANSWER).repartition(parts, "batch")

    by_batch = dealt.groupBy("batch")
    anchors = answered(by_batch.applyInArrow(probe, _MESSAGE))
    full = answered(by_batch.cogroup(anchors.groupBy("batch")).applyInArrow(extend, _MESSAGE))
    both = anchors.unionByName(full).repartition(parts, "batch")
    return by_batch.cogroup(both.groupBy("batch")).applyInArrow(remove, schema).withColumnRenamed("id", id_col)


_SPANS = pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64())]))
