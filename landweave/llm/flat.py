"""Whole Arrow batches as flat byte arrays: words, hashes and shingles without a loop over rows.

All word classes used here separate at ASCII bytes only, so bytes of 0x80 and above are always
inside a word and UTF-8 never has to be decoded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; a longer single text is a slice of its own.
SLICE_BYTES = 1 << 19

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

BLANKS = np.ones(256, dtype=bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = False

_BASE = np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = max(n, 1024)
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, _BASE, dtype=np.uint64)]), dtype=np.uint64)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes and the n+1 offsets of a string column; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(data: np.ndarray, offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows (first, last+1, bytes, offsets) of about size bytes each."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1)
        last = min(last, n)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = BLANKS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row the index of its first word (n+1 values)."""
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(offsets), dtype=np.int64)
    is_word = inside[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    begins = is_word.copy()
    begins[1:] &= ~is_word[:-1] | cut[1:-1]
    ends = is_word.copy()
    ends[:-1] &= ~is_word[1:] | cut[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, of its bytes alone."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    lengths = ends - starts
    first = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(first[-1]) - np.repeat(first[:-1], lengths)
    p = powers(int(lengths.max()) + 1)
    values = (data[np.repeat(starts, lengths) + at].astype(np.uint64) + np.uint64(1)) * p[at]
    return mix(np.add.reduceat(values, first[:-1]) + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive words; len(hashes)-n+1 values, row boundaries not regarded."""
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64)
    p, size = powers(n + 1), len(hashes) - n + 1
    total = np.zeros(size, dtype=np.uint64)
    for k in range(n):
        total += hashes[k : k + size] * p[k]
    return mix(total + np.uint64(n))
