"""Words and windows of whole texts as numpy arrays.

The helpers take the Arrow string columns that Spark passes to Python workers
and handle a few rows at a time, so memory follows the longest text, not the
batch. A word is a run of bytes other than space and 0x09-0x0D, which in UTF-8
is the same as ``[^\\x20\\x09-\\x0D]+`` over code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD1342543DE82EF95)


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)


def segment_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each non-empty ``buf[start:end]``."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    inside = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    powers = np.multiply.accumulate(np.full(int(sizes.max()), _BASE))
    values = _BYTE[buf[np.repeat(starts, sizes) + inside]] * powers[inside]
    return mixed(np.add.reduceat(values, first))


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive values of ``h``, ``len(h) - k + 1`` of them."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    value, at, width, power = None, 0, 1, h
    while True:
        if k & width:
            piece = power[at:at + n]
            value = mixed(piece + np.uint64(width)) if value is None else mixed(value * _ODD + piece)
            at += width
        if 2 * width > k:
            return value
        power = mixed(power[:-width] * _ODD + power[width:])
        width *= 2


class Words:
    """Words of consecutive texts: byte ranges, row of each, words per row."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        self.buf, self.offsets, self.rows = buf, offsets, len(offsets) - 1
        inside = ~SPACE[buf]
        edge = np.zeros(len(buf) + 1, bool)
        edge[offsets] = True
        before = np.zeros(len(buf) + 1, bool)
        before[1:] = inside
        here = np.zeros(len(buf) + 1, bool)
        here[:-1] = inside
        self.inside = inside
        self.starts = np.flatnonzero(here & (~before | edge))
        self.ends = np.flatnonzero(before & (~here | edge))
        self.first = np.searchsorted(self.starts, offsets)
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(self.rows), self.count)

    def hashes(self) -> np.ndarray:
        return segment_hashes(self.buf, self.starts, self.ends)

    def windows(self, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the k-word windows that lie in one text, and their first words."""
        within = np.flatnonzero(self.row[:len(h) - k + 1] == self.row[k - 1:]) if len(h) >= k else np.zeros(0, np.int64)
        return window_hashes(h, k)[within], within


def pieces(column: pa.Array, lower: bool = False, most: int = PIECE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) of runs of rows with about ``most`` bytes; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        buf = data[offsets[at]:offsets[end]]
        yield at, end, Words(LOWER[buf] if lower else buf, offsets[at:end + 1] - offsets[at])
        at = end


def per_row(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``values`` by row, as longs."""
    return np.bincount(rows, values, n).astype(np.int64) if len(rows) else np.zeros(n, np.int64)
