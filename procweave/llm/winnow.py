"""Vectorized text windows: hashes of words or bytes, winnowed anchors and super-k-mers.

A *unit* is a byte or a word. A window is ``size`` consecutive units of one document. Every window has one
*anchor*: the k-mer of least hash in it (leftmost of equals). Windows with equal content have equal anchors,
so equal windows of different documents meet when the rows are dealt out by anchor. Consecutive windows with the
same anchor form one *super-k-mer*, which travels as one row.
"""

from __future__ import annotations

import numpy as np

#: White space of the word contracts: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = b" \t\n\x0b\x0c\r"
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_POSITION_BITS = 28
_LOW = np.uint64((1 << _POSITION_BITS) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer on an array of uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_table(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed))


BYTES = byte_table(1)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) <= n:
        size = max(1 << 20, 1 << int(n).bit_length())
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _powers[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, b, np.uint64)]), dtype=np.uint64) for b in (_BASE, inverse)]
    return _powers[0], _powers[1]


class Sequence:
    """Units of one or more documents in a row, with hashes of any span by prefix sums."""

    def __init__(self, units: np.ndarray):
        self.units = units
        up, self._down = powers(len(units))
        self._sums = np.zeros(len(units) + 1, dtype=np.uint64)
        np.cumsum(units * up[: len(units)], out=self._sums[1:])

    def fixed(self, length: int) -> np.ndarray:
        """Hashes of all spans of one length."""
        n = len(self.units) - length + 1
        return (self._sums[length:] - self._sums[:-length]) * self._down[:n] if n > 0 else np.zeros(0, np.uint64)

    def spans(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self._sums[stop] - self._sums[start]) * self._down[start]


def words(buffer: np.ndarray, table: np.ndarray = BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of each word of a byte buffer; a word is a run of bytes that are no white space."""
    inside = ~_IS_SPACE[buffer]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    start, stop = edges[::2], edges[1::2]
    return mix(Sequence(table[buffer]).spans(start, stop) + (stop - start).astype(np.uint64)), start, stop


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, in log2(width) passes."""
    if len(x) < width:
        return x[:0]
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


class SuperKmers:
    """Super-k-mers of concatenated documents: row arrays ``doc`` (position of its document), ``lo`` and ``hi``
    (first and last window, counted in the whole sequence), ``anchor`` (hash of the k-mer) and ``content``
    (hash of all units under the windows and of the anchor's place)."""

    def __init__(self, units: np.ndarray, lengths: np.ndarray, size: int, k: int):
        self.size, self.sequence = size, Sequence(units)
        ends = np.cumsum(lengths)
        n = len(units) - size + 1
        if n <= 0:
            self.doc = self.lo = self.hi = np.zeros(0, np.int64)
            self.anchor = self.content = np.zeros(0, np.uint64)
            return
        grams = self.sequence.fixed(k)
        key = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
        place = (sliding_min(key, size - k + 1) & _LOW).astype(np.int64)
        del key
        first = np.ones(n, dtype=bool)
        np.not_equal(place[1:], place[:-1], out=first[1:])
        first[ends[:-1][ends[:-1] < n]] = True
        lo = np.flatnonzero(first)
        hi = np.concatenate([lo[1:], [n]]) - 1
        doc = np.searchsorted(ends, lo, side="right")
        hi = np.minimum(hi, ends[doc] - size)
        whole = lo <= hi
        self.lo, self.hi, self.doc = lo[whole], hi[whole], doc[whole]
        at = place[self.lo]
        self.anchor = mix(grams[at])
        self.content = mix(self.sequence.spans(self.lo, self.hi + size) ^ mix((at - self.lo).astype(np.uint64) + np.uint64(7)))


def grow(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All integers of the runs [start, start + count), in order."""
    total = int(count.sum())
    offset = np.repeat(start - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    return np.arange(total) + offset


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).view(np.int8)))
    return edges[::2], edges[1::2]


def covered(n: int, windows: np.ndarray, size: int) -> np.ndarray:
    """Which of n units lie under at least one of the windows that start at the given places."""
    depth = np.zeros(n + 1, dtype=np.int32)
    np.add.at(depth, windows, 1)
    np.subtract.at(depth, windows + size, 1)
    return np.cumsum(depth[:-1]) > 0
