"""Vectorised access to the words of a batch of texts.

A word is a maximal run of bytes outside ``20`` and ``09``-``0D`` (hex); since UTF-8 never uses these bytes inside a
character, this equals the pattern ``[^\\x20\\x09-\\x0D]+`` over code points.  Hashes are 64-bit: a polynomial over
random byte values, then a finaliser, so equal words always have equal hashes, and different ones collide with a chance of about
``2**-64`` a pair.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes of text that are worked on at once; a longer text is a piece of its own.
PIECE_BYTES = 1_000_000
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**64 - 1, 256, dtype=U)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_ODD = _rng.integers(0, 2**63, 64, dtype=U) * U(2) + U(1)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64; kept, as every piece needs them."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, PIECE_BYTES + 4096)
        have = np.full(size, base % 2**64, dtype=U)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 4 * PIECE_BYTES:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class Prefix:
    """Hashes of any byte ranges of one buffer, in constant time each."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, dtype=U)
        np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=self.sums[1:])
        self.back = powers(_INVERSE, len(data) + 1)

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(U) * _ODD[63])


class Piece:
    """Some whole documents: their bytes in one buffer, and where each begins."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, first: int):
        self.data, self.bounds, self.first, self.n = data, bounds, first, len(bounds) - 1

    def words(self, separators: np.ndarray = SPACE) -> None:
        """Sets ``start``, ``end`` (bytes of each word) and ``at`` (where the words of each document begin)."""
        inside = ~separators[self.data]
        edges = np.zeros(len(self.data) + 1, bool)
        edges[1:-1] = inside[1:] != inside[:-1]
        if len(inside):
            edges[0], edges[-1] = inside[0], inside[-1]
        cuts = self.bounds[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(inside))]
        split = np.unique(cuts[inside[cuts] & inside[cuts - 1]])  # a word ends and another begins there
        edge = np.flatnonzero(edges)
        if len(split):
            edge = np.sort(np.concatenate([edge, split, split]))
        self.start, self.end = edge[0::2], edge[1::2]
        self.at = np.searchsorted(self.start, self.bounds)

    def hashes(self) -> np.ndarray:
        """Hash of each word; a long text is hashed some megabytes at a time."""
        if len(self.data) <= 2 * PIECE_BYTES:
            return Prefix(self.data).ranges(self.start, self.end)
        out, first = np.zeros(len(self.start), dtype=U), 0
        while first < len(out):
            low = self.start[first]
            last = max(first + 1, int(np.searchsorted(self.start, low + PIECE_BYTES)))
            some = slice(first, last)
            out[some] = Prefix(self.data[low : self.end[last - 1]]).ranges(self.start[some] - low, self.end[some] - low)
            first = last
        return out

    def windows(self, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the n-word window at each word, and whether it lies within one document."""
        total = len(words)
        out, fits = np.zeros(total, dtype=U), np.zeros(total, bool)
        whole = total - n + 1
        if whole > 0:
            sums = np.zeros(total + 1, dtype=U)
            np.cumsum(words * powers(_BASE, total), out=sums[1:])
            out[:whole] = mix((sums[n:] - sums[:whole]) * powers(_INVERSE, whole) + _ODD[n % 63])
            fits = np.arange(n, total + n) <= np.repeat(self.at[1:], np.diff(self.at))
        return out, fits


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, and the bounds of each value; a null is an empty value."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    if not (pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)):
        column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), bounds


def pieces(column: pa.Array | pa.ChunkedArray, most: int = PIECE_BYTES) -> Iterator[Piece]:
    """The texts of a column, in order, as pieces of at most about ``most`` bytes."""
    data, bounds = text_buffers(column)
    first, rows = 0, len(bounds) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + most, side="right")) - 1)
        last = min(last, rows, first + 50_000)
        yield Piece(data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first], first)
        first = last


def trim() -> None:
    """Gives memory that is free back to the system, where its allocators can: Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass
