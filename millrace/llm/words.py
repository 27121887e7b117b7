"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

Separators are ASCII in every word rule used here, so words can be cut on bytes. A
word's 64-bit hash is a polynomial over random byte values, taken from prefix sums
modulo 2**64; hashes of word sequences are polynomials over word hashes. Nothing here
loops over words in Python.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15 | 5)
_CHUNK = 1 << 17


def _inverse(odd: int) -> int:
    return pow(int(odd), -1, 1 << 64)


@functools.lru_cache(8)
def _powers(base: int, bits: int) -> np.ndarray:
    out = np.full(1 << bits, base, dtype=U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


def powers(base: int, n: int) -> np.ndarray:
    return _powers(int(base), max(10, int(n).bit_length()))[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole word."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@functools.cache
def _values(lower: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
    if lower:
        values = values.copy()
        values[65:91] = values[97:123]
    return values


def _table(separators: list[tuple[int, int]]) -> np.ndarray:
    keep = np.ones(256, dtype=bool)
    for first, last in separators:
        keep[first : last + 1] = False
    return keep


#: Bytes of a word: all but ASCII white space; or digits, letters and anything beyond ASCII.
SPACED = _table([(0x20, 0x20), (0x09, 0x0D)])
ALNUM = _table([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])


class Words:
    """The words of an Arrow column of texts; a null text is an empty one.

    starts, ends: byte places; first: the words of text i are first[i] to first[i + 1].
    """

    def __init__(self, column: pa.Array | pa.ChunkedArray, word_bytes: np.ndarray, lower: bool):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        column = pc.fill_null(column.cast(pa.large_string()), "")
        self.n, self.lower = len(column), lower
        _, offsets, data = column.buffers()
        self.offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + self.n + 1] if self.n else np.zeros(1, np.int64)
        self.buf = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        a, b = int(self.offsets[0]), int(self.offsets[-1])
        inside = word_bytes[self.buf[a:b]]
        edge = np.zeros(b - a + 1, dtype=bool)
        edge[self.offsets - a] = True
        before = np.zeros(b - a, dtype=bool)
        after = np.zeros(b - a, dtype=bool)
        if b > a:
            before[1:] = inside[:-1] & ~edge[1:-1]
            after[:-1] = inside[1:] & ~edge[1:-1]
        self.starts = np.flatnonzero(inside & ~before) + a
        self.ends = np.flatnonzero(inside & ~after) + a + 1
        self.first = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    @functools.cached_property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @functools.cached_property
    def stop(self) -> np.ndarray:
        """For each word, where its text's words end."""
        return np.repeat(self.first[1:], self.counts)

    @functools.cached_property
    def hashes(self) -> np.ndarray:
        out = np.empty(len(self), dtype=U64)
        values, inverse = _values(self.lower), _inverse(_BASE)
        at = 0
        while at < len(self):
            # As many words as end within a chunk, at least one however long it is.
            to = max(at + 1, int(np.searchsorted(self.ends, self.starts[at] + _CHUNK, side="right")))
            a, b = int(self.starts[at]), int(self.ends[to - 1])
            sums = np.zeros(b - a + 1, dtype=U64)
            np.cumsum(values[self.buf[a:b]] * powers(_BASE, b - a), out=sums[1:])
            s, e = self.starts[at:to] - a, self.ends[at:to] - a
            out[at:to] = (sums[e] - sums[s]) * powers(inverse, b - a)[s]
            at = to
        return mix(out)

    def text(self, i: int) -> bytes:
        return self.buf[self.offsets[i] : self.offsets[i + 1]].tobytes()


def windows(hashes: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """Hashes of all runs of width words, by first word; runs over the end of the array are left out."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, dtype=U64)
    base = int(mix(np.array([seed * 2 + 1], dtype=U64))[0]) | 5
    sums = np.zeros(n + 1, dtype=U64)
    np.cumsum(hashes * powers(base, n), out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * powers(_inverse(base), n)[: n - width + 1])


def spans(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one-past-last places of the runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], covered.view(np.int8), [0]))))
    return edges[::2], edges[1::2]


def cover(at: np.ndarray, width: np.ndarray | int, n: int) -> np.ndarray:
    """Which of n places lie in a run that begins at one of the places at."""
    depth = np.zeros(n + 1, dtype=np.int32)
    np.add.at(depth, at, 1)
    np.add.at(depth, np.minimum(at + width, n), -1)
    return np.cumsum(depth[:-1]) > 0
