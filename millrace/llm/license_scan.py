"""License scans: exact set-similarity join of text blocks with license notices.

Tokens are pairs of consecutive words, so a block must hold a notice's wording and not
just its words. A notice of L words is sought in blocks of 2 * S words that begin at every
S-th word of a text, S being the least power of two (4 or more) that is L or more: any
stretch as long as the notice lies whole in one of them, however long the notice, and a
notice that was edited a little does too unless it grew beyond S words. A block meets a
notice if it holds at least `threshold` of the notice's distinct tokens.

One pass over all documents counts the notices' tokens. Rarest first is the global order.
A block that meets a notice of m tokens with t = ceil(threshold * m) of them must hold one
of the notice's first m - t + 1 (prefix filter); must hold t tokens of any notice at all
(length filter); and, from the first token that matches, must have enough tokens left on
both sides (positional filter). What passes is counted in full, so the join is exact. The
notices are a parameter, whole in memory, and travel with the code; documents aren't
shuffled.

Base labels come from phrases, found wherever their words stand consecutively.

Defined cases: a null or empty text has no words, places or labels and score 0; a notice
of one word has no token and meets nothing; very long texts are scanned whole; notices
that a block meets equally well all give their labels; repeated rows are judged alike;
empty tables give no rows. Extra columns are carried, whatever their names; columns named
like an output are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, without
from .decontaminate import _among, _portions
from .licenses import NOTICES
from .words import ALNUM, Words, windows

#: Phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

_OUT = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def _hash_words(text: str) -> np.ndarray:
    return Words(pa.array([text], pa.string()), ALNUM, lower=True).hashes


def _tokens(h: np.ndarray) -> np.ndarray:
    """Hashes of all pairs of neighbours, by first word."""
    return windows(h, 2, 9)


def step_of(words: int) -> int:
    """How far apart blocks for a notice of so many words begin; they are twice as long."""
    return max(4, 1 << (words - 1).bit_length())


class _Templates:
    """Notices as sets of token numbers in the global order."""

    def __init__(self, templates: tuple[tuple[str, str], ...], counts: dict[int, int], threshold: float):
        words = [_hash_words(text) for text, _ in templates]
        sets = [set(_tokens(h).tolist()) for h in words]
        order = sorted(set().union(*sets), key=lambda h: (counts.get(h, 0), h)) if sets else []
        rank = {h: i for i, h in enumerate(order)}
        self.known = np.array(sorted(order), dtype=np.uint64)
        self.rank = np.array([rank[h] for h in self.known.tolist()], dtype=np.int64)
        self.labels = [label for _, label in templates]
        self.tokens = [sorted(rank[h] for h in s) for s in sets]
        self.need = [max(1, math.ceil(threshold * len(s) - 1e-9)) for s in sets]
        # By step: the prefix index of the notices sought in blocks of that size, and the least tokens that any needs.
        self.kinds: dict[int, tuple[dict[int, list[tuple[int, int]]], int]] = {}
        for n, (h, tokens, need) in enumerate(zip(words, self.tokens, self.need)):
            if tokens:
                index, least = self.kinds.get(step_of(len(h)), ({}, need))
                for i, token in enumerate(tokens[: len(tokens) - need + 1]):
                    index.setdefault(token, []).append((n, i))
                self.kinds[step_of(len(h))] = index, min(least, need)

    def matches(self, index: dict[int, list[tuple[int, int]]], block: list[int]) -> dict[int, float]:
        """Notices of the index that this block (sorted distinct token numbers) meets, with their containment."""
        out: dict[int, float] = {}
        seen: set[int] = set()
        own = set(block)
        for j, token in enumerate(block):
            for n, i in index.get(token, ()):
                if n in seen:
                    continue
                seen.add(n)
                tokens, need = self.tokens[n], self.need[n]
                if len(block) < need or 1 + min(len(tokens) - i - 1, len(block) - j - 1) < need:
                    continue
                common = len(own.intersection(tokens))
                if common >= need:
                    out[n] = common / len(tokens)
        return out


def token_counts(docs: DataFrame, known: np.ndarray, text_col: str = "text") -> dict[int, int]:
    """How often each notice's token occurs in all texts; one row for each."""
    schema = "t long, n long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            for part in _portions(batch, 0):
                tokens, at = _places_of(Words(part.column(0), ALNUM, lower=True), known)
                total += np.bincount(np.searchsorted(known, tokens[at]), minlength=len(known))
        yield pa.RecordBatch.from_arrays([pa.array(known.astype(np.int64)), pa.array(total)], names=["t", "n"])

    if not len(known):
        return {}
    rows = docs.select(F.col(f"`{text_col}`")).mapInArrow(count, schema).groupBy("t").agg(F.sum("n").alias("n")).collect()
    return {r.t & 0xFFFFFFFFFFFFFFFF: r.n for r in rows}


def _places_of(words: Words, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All tokens, and the places of the known ones; a token doesn't go over a text's end."""
    tokens = _tokens(words.hashes)
    at = _among(tokens, known)
    return tokens, at[at + 2 <= words.stop[at]]


def scan_licenses(
    docs: DataFrame,
    phrases: tuple[tuple[str, str], ...] = PHRASES,
    templates: tuple[tuple[str, str], ...] = NOTICES,
    threshold: float = 0.8,
    text_col: str = "text",
) -> DataFrame:
    """docs with n_words, n_base, first_word, last_word, base_labels, labels and score.

    score: 1 with a base phrase, else the largest containment of a notice that is met, else 0.
    """
    bounded_batches(docs.sparkSession)
    docs = without(docs, *[f.name for f in T._parse_datatype_string(_OUT).fields])
    known = _Templates(templates, {}, threshold).known
    held = _Templates(templates, token_counts(docs, known, text_col), threshold)
    sought = [(_hash_words(text), label) for text, label in phrases]
    at_text = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, *T._parse_datatype_string(_OUT).fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _portions(batch, at_text):
                words = Words(part.column(at_text), ALNUM, lower=True)
                n_base, first, last = [0] * words.n, [None] * words.n, [None] * words.n
                base: list[set[str]] = [set() for _ in range(words.n)]
                for phrase, label in sought:
                    for i, w in _places(words, phrase):
                        n_base[i] += 1
                        first[i] = w if first[i] is None else min(first[i], w)
                        last[i] = w if last[i] is None else max(last[i], w)
                        base[i].add(label)
                score = [1.0 if n else 0.0 for n in n_base]
                labels = [set(x) for x in base]
                for i, n, containment in _joined(words, held):
                    labels[i].add(held.labels[n])
                    score[i] = max(score[i], containment)
                joined = lambda xs: pa.array([",".join(sorted(x)) for x in xs], pa.string())
                columns = [pa.array(words.counts, pa.int64()), *(pa.array(x, pa.int64()) for x in (n_base, first, last)), joined(base), joined(labels), pa.array(score, pa.float64())]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=schema.names)

    return docs.mapInArrow(scan, schema)


def _places(words: Words, phrase: np.ndarray) -> Iterator[tuple[int, int]]:
    """(text, first word within it) of every place where the phrase stands."""
    h, k = words.hashes, len(phrase)
    at = np.flatnonzero(h[: max(0, len(h) - k + 1)] == phrase[0])
    for j in range(1, k):
        at = at[h[at + j] == phrase[j]]
    at = at[at + k <= words.stop[at]]
    text = np.searchsorted(words.first, at, side="right") - 1
    yield from zip(text.tolist(), (at - words.first[text]).tolist())


def _joined(words: Words, held: _Templates) -> Iterator[tuple[int, int, float]]:
    """(text, notice, containment) for every block and notice that it meets."""
    if not held.kinds or not len(words):
        return
    tokens, at = _places_of(words, held.known)
    token = held.rank[np.searchsorted(held.known, tokens[at])]
    text = np.searchsorted(words.first, at, side="right") - 1
    place, size = at - words.first[text], len(held.known)
    for step, (index, least) in held.kinds.items():
        # Block k has the words from k * step on; a token is in the block that it begins in and, but for the last place of a step, in the one before.
        k = place // step
        both = np.flatnonzero((k > 0) & (place % step < step - 1))
        blocks = np.concatenate((k, k[both] - 1)) + (np.concatenate((text, text[both])) << 32)
        blocks, number = np.unique(blocks, return_inverse=True)
        # Distinct (block, token), in order; then only blocks with enough tokens of any notice and one of a prefix.
        pairs = np.unique(number * size + np.concatenate((token, token[both])))
        block_of, token_of = pairs // size, pairs % size
        prefix = np.zeros(size, dtype=bool)
        prefix[list(index)] = True
        starts = np.flatnonzero(np.diff(block_of, prepend=-1))
        stops = np.append(starts[1:], len(pairs))
        if not len(starts):
            continue
        go = (stops - starts >= least) & np.logical_or.reduceat(prefix[token_of], starts)
        for a, b in zip(starts[go].tolist(), stops[go].tolist()):
            for n, containment in held.matches(index, token_of[a:b].tolist()).items():
                yield int(blocks[block_of[a]]) >> 32, n, containment
