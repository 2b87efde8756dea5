"""Hashes of words and word windows over whole Arrow string columns, without a Python object per word.

A word is a maximal run of bytes other than ASCII white space. Both levels are Rabin-Karp polynomials
modulo 2**64 over random symbols, read off prefix sums: ``(P[end] - P[start]) / B**start``, then mixed.
Two different words or windows share a hash with a chance of about 2**-60.
"""

from __future__ import annotations

import contextlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors may lack this package

def give_back() -> None:
    """Return freed memory to the system, so that an idle Python worker leaves it to the next stage."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        import ctypes

        with contextlib.suppress(OSError, AttributeError):  # only the usual C library has it
            ctypes.CDLL(None).malloc_trim(0)


SLICE_BYTES = 1 << 20  # bytes hashed at once; bounds the scratch arrays unless one text is longer
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93
GAPS = np.zeros(256, bool)
GAPS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
SYMBOLS = np.random.default_rng(20240229).integers(1, 2**64, 256, dtype=np.uint64)
LOWER_SYMBOLS = SYMBOLS.copy()
LOWER_SYMBOLS[65:91] = SYMBOLS[97:123]
NOT_LETTERS = np.arange(256) < 128  # separators for words of letters: all of ASCII but A-Z and a-z
NOT_LETTERS[65:91] = NOT_LETTERS[97:123] = False


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    if data is None or not len(column):
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = GAPS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and each row's first word (one entry more than rows)."""
    inside = ~gaps[data]
    opens, closes = inside.copy(), inside.copy()
    edges = np.zeros(len(data) + 1, bool)
    edges[offsets] = True
    opens[1:] &= ~inside[:-1] | edges[1:-1]
    closes[:-1] &= ~inside[1:] | edges[1:-1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[:1] = 1
    return np.cumprod(p)


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """The polynomial of ``values[start:end]`` for each span."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=sums[1:])
    inverse = powers(pow(base, -1, 1 << 64), len(values) + 1)
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def slices(offsets: np.ndarray, limit: int):
    """Consecutive row ranges of at most ``limit`` units each, or one row."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, stop
        row = stop


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, lower: bool = False, gaps: np.ndarray = GAPS
) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, and each row's first word; ``lower`` folds A-Z."""
    symbols, hashes, firsts, n = LOWER_SYMBOLS if lower else SYMBOLS, [], [np.zeros(1, np.int64)], 0
    for a, b in slices(offsets, SLICE_BYTES):
        part = data[offsets[a] : offsets[b]]
        starts, ends, first = words(part, offsets[a : b + 1] - offsets[a], gaps)
        hashes.append(spans_hash(symbols[part], starts, ends, BYTE_BASE))
        firsts.append(first[1:] + n)
        n += len(starts)
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), np.concatenate(firsts)


def windows(hashes: np.ndarray, firsts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all windows of ``size`` words within a row: hash, position of its first word, and row."""
    counts = np.maximum(np.diff(firsts) - size + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    begin = np.cumsum(counts) - counts
    at = np.arange(counts.sum()) - np.repeat(begin - firsts[:-1], counts)
    out = np.empty(len(at), np.uint64)
    for a, b in slices(firsts, SLICE_BYTES):
        lo, hi = int(begin[a]), int(begin[b - 1] + counts[b - 1])
        start = at[lo:hi] - firsts[a]
        out[lo:hi] = spans_hash(hashes[firsts[a] : firsts[b]], start, start + size, WORD_BASE)
    return out, at, rows
