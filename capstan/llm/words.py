"""Vectorised word primitives over Arrow text columns.

A word is a maximal run of bytes outside ``WHITE`` (``[^\\x20\\x09-\\x0D]+``);
the separators are ASCII, so cutting UTF-8 bytes and cutting code points give
the same words.  All functions work on the byte buffer of a slice of documents
at once; a NULL text has no word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WHITE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
SLICE_BYTES = 2 << 20            # documents are worked on in slices of about this many bytes

_NONWHITE = np.ones(256, bool)
_NONWHITE[list(WHITE)] = False
LOWER = np.arange(256, dtype=np.uint8)      # A-Z to a-z, every other byte unchanged
LOWER[65:91] += 32

_P = np.uint64(0x9E3779B97F4A7C15)
_SPAN = 1 << 16
_POW = np.concatenate([[np.uint64(1)], np.cumprod(np.full(_SPAN - 1, _P, np.uint64))])
_STEP = np.uint64(0xD1342543DE82EF95)       # odd: one power per span of a very long word


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser: every output bit depends on every input bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of consecutive documents; one document is never cut."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + max_bytes, "right")) - 1)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``inside`` within each document: (starts, ends, first run of each document)."""
    n = len(inside)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = offsets[offsets < n]
    first[cut] = inside[cut]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = offsets[offsets > 0] - 1
    last[cut] = inside[cut]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """64-bit hash of each run's bytes; works on about ``block`` bytes at a time."""
    edge = np.concatenate([[0], np.cumsum(ends - starts)])
    out = np.zeros(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(edge, edge[lo] + block, "right")) - 1)
        out[lo:hi] = _hash_block(data, starts[lo:hi], ends[lo:hi])
        lo = hi
    return out


def _hash_block(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    length = ends - starts
    edge = np.concatenate([[0], np.cumsum(length)])
    total = int(edge[-1])
    pos = np.arange(total, dtype=np.int64) - np.repeat(edge[:-1], length)
    values = data[pos + np.repeat(starts, length)].astype(np.uint64) + np.uint64(1)
    if total and int(length.max()) >= _SPAN:
        step = np.concatenate([[np.uint64(1)], np.cumprod(np.full(int(length.max()) // _SPAN, _STEP, np.uint64))])
        values *= step[pos // _SPAN]
        pos %= _SPAN
    values *= _POW[pos]
    h = np.zeros(len(length), np.uint64)
    some = length > 0
    if total:
        h[some] = np.add.reduceat(values, edge[:-1][some])
    return mix(h ^ (length.astype(np.uint64) << np.uint64(40)))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each document) of a slice."""
    return runs(_NONWHITE[data], offsets)


def ngram_hashes(h: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of n consecutive words of one document.

    Returns (hash, word index where it starts, first n-gram of each document).
    """
    count = np.diff(first)
    grams = np.maximum(count - n + 1, 0)
    gfirst = np.concatenate([[0], np.cumsum(grams)])
    at = np.arange(int(gfirst[-1]), dtype=np.int64) + np.repeat(first[:-1] - gfirst[:-1], grams)
    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        out = out * np.uint64(0xFF51AFD7ED558CCD) + h[at + k]
        out ^= out >> np.uint64(29)
    return mix(out), at, gfirst


def segment_sum(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` per segment ``first[i]:first[i + 1]`` (empty segments: 0)."""
    c = np.concatenate([[0], np.cumsum(values)])
    return c[first[1:]] - c[first[:-1]]


def take_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated bytes of the spans, and their offsets."""
    length = ends - starts
    off = np.concatenate([[0], np.cumsum(length)])
    index = np.arange(int(off[-1]), dtype=np.int64) + np.repeat(starts - off[:-1], length)
    return data[index], off
