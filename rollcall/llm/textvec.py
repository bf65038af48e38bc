"""Words of whole Arrow string columns as numpy arrays.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D in the UTF-8 text
(the same as ``[^\\x20\\x09-\\x0D]+`` on characters, since those bytes never occur inside
a longer UTF-8 sequence).  Nothing here builds a Python string per word: a batch's
character buffer is scanned at once, and a word or a window of words is named by a
64-bit polynomial hash taken from prefix sums.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
BYTE_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
WORD_BASE = 0xC2B2AE3D27D4EB4F
CHUNK_BYTES = 1 << 19

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(CHUNK_BYTES + 1, n)
        steps = np.full(size, base, dtype=U)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if size > 8 * CHUNK_BYTES:
            return have[:n]  # a table for one enormous text isn't kept
        _powers[base] = have
    return have[:n]


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for a task of a reused Python worker: what it kept is freed at its end, not whenever garbage is next collected."""

    def task(batches):
        try:
            yield from run(batches)
        finally:
            _powers.clear()
            gc.collect()

    return task


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose every output bit depends on every input bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n + 1 offsets of its rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    if not (wide or pa.types.is_string(column.type)):
        column, wide = column.cast(pa.large_string()), True
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], (at - at[0]).astype(np.int64)


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of about ``size`` bytes each; one row is never divided."""
    data, offsets = column_bytes(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all else unchanged."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


class Words:
    """The words of one chunk: byte ``starts`` and ``ends``, and ``first[i]:first[i + 1]`` per row ``i``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        n = len(data)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = ~((data == 32) | ((data >= 9) & (data <= 13)))
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        self.starts = np.flatnonzero(inside[1 : n + 1] & (~inside[:n] | edge[:n]))
        self.ends = np.flatnonzero(inside[1 : n + 1] & (~inside[2 : n + 2] | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A hash of each word's bytes."""
        n = len(self.data)
        total = np.zeros(n + 1, U)
        np.cumsum((self.data.astype(U) + U(1)) * powers(BYTE_BASE, n), out=total[1:])
        inverse = powers(pow(BYTE_BASE, -1, 1 << 64), n + 1)
        return mix((total[self.ends] - total[self.starts]) * inverse[self.starts])


class Windows:
    """Hashes of runs of consecutive words, any length at once, from one prefix sum."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.n, self.total = n, np.zeros(n + 1, U)
        np.cumsum(words * powers(WORD_BASE, n), out=self.total[1:])
        self.inverse = powers(pow(WORD_BASE, -1, 1 << 64), n + 1)

    def hashes(self, length: int) -> np.ndarray:
        """Hash of the window that starts at each word and has ``length`` words; rows must be told apart by the caller."""
        if self.n < length:
            return np.zeros(0, U)
        at = self.n - length + 1
        return mix((self.total[length:] - self.total[:at]) * self.inverse[:at] + U(length))

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.total[ends] - self.total[starts]) * self.inverse[starts] + (ends - starts).astype(U))

    def valid(self, first: np.ndarray, length: int) -> np.ndarray:
        """Which windows of ``length`` words lie inside one row (``first`` as in ``Words``)."""
        keep = np.ones(max(self.n - length + 1, 0), bool)
        for back in range(1, length):
            at = first[1:] - back
            at = at[(at >= 0) & (at < len(keep))]
            keep[at] = False
        return keep


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost smallest of every ``width`` consecutive values."""
    at, span = np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        left, right = at[: max(len(at) - step, 0)], at[step:]
        at = np.where(values[left] <= values[right], left, right)
        span += step
    return at


class Spans:
    """Hashes of byte spans of one buffer."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.total = np.zeros(n + 1, U)
        np.cumsum((data.astype(U) + U(1)) * powers(BYTE_BASE, n), out=self.total[1:])
        self.inverse = powers(pow(BYTE_BASE, -1, 1 << 64), n + 1)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.total[ends] - self.total[starts]) * self.inverse[starts])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i] + lengths[i] - 1`` of all i in turn."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
