"""Vectorised text primitives on UTF-8 bytes: word spans, 64-bit hashes, shingles.

All functions work on a whole chunk of documents at once (one ``uint8`` buffer plus document
offsets), so Python runs per chunk, not per word.  Hashes are polynomial fingerprints modulo
2**64 over random byte codes with a final mix; they depend on nothing but the bytes, so every
executor, and every retry, computes the same value.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def splitmix(n: int, seed: int) -> np.ndarray:
    """``n`` pseudo-random 64-bit values from ``seed``."""
    out, state = np.empty(n, np.uint64), seed & _MASK
    for i in range(n):
        state = (state + 0x9E3779B97F4A7C15) & _MASK
        z = ((state ^ (state >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & _MASK
        out[i] = z ^ (z >> 31)
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that all bits are usable."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


#: Byte codes; lower-casing A-Z is folded into LOWER_CODES.
CODES = splitmix(256, 17)
LOWER_CODES = CODES.copy()
LOWER_CODES[65:91] = CODES[97:123]
_ORDER = splitmix(64, 29) | np.uint64(1)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Boolean table of the bytes in the inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: ``[\x20\x09-\x0D]``
SPACE = byte_class((0x20, 0x20), (0x09, 0x0D))
#: Everything in ASCII but digits and letters (letters of either case count as words).
PUNCT = byte_class((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))

#: Bytes that are hashed at a time; spans longer than that are hashed piece by piece.
_BLOCK = 1 << 18


@functools.cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, as many as two blocks need."""
    out = []
    for base in (_BASE, _BASE_INVERSE):
        steps = np.full(2 * _BLOCK + 1, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets (one more than rows) of a string column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), offsets


def chunks(column: pa.Array, most: int = 1 << 21) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a column into runs of rows of about ``most`` bytes: (first row, end row, bytes, offsets).

    A single longer text forms a run of its own, whole.
    """
    data, offsets = buffers(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of non-separators, and each document's range of words."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~separators[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    at = offsets[:-1][offsets[:-1] < len(data)]
    first[at] = inside[at]
    at = offsets[1:][offsets[1:] > 0] - 1
    last[at] = inside[at]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray = LOWER_CODES) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; ``starts`` must not decrease.

    Works on a block of bytes at a time: beside the spans, memory does not grow with the text.
    """
    up, down = _powers()
    size = ends - starts
    out = np.zeros(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = int(starts[at])
        end = int(np.searchsorted(starts, low + _BLOCK))
        own = np.arange(at, end)
        short = own[size[at:end] <= _BLOCK]
        if len(short):
            high = int(ends[short].max())
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum(codes[data[low:high]] * up[: high - low], out=sums[1:])
            out[short] = (sums[ends[short] - low] - sums[starts[short] - low]) * down[starts[short] - low]
        for i in own[size[at:end] > _BLOCK].tolist():
            total, scale, step = 0, 1, pow(_BASE, _BLOCK, 1 << 64)
            for a in range(int(starts[i]), int(ends[i]), _BLOCK):
                piece = codes[data[a : min(a + _BLOCK, int(ends[i]))]]
                total = (total + scale * int((piece * up[: len(piece)]).sum(dtype=np.uint64))) & _MASK
                scale = scale * step & _MASK
            out[i] = total
        at = end
    return mix(out + size.astype(np.uint64))


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """Order-sensitive hash of each ``size`` consecutive hashes."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = hashes[:n] * _ORDER[0]
    for j in range(1, size):
        total += hashes[j : n + j] * _ORDER[j]
    return mix(total)


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word shingles of each document and each document's range of them.

    A document of fewer words, but at least one, has its whole sequence as its one shingle.
    """
    counts = np.diff(bounds)
    each = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    ranges = np.concatenate(([0], np.cumsum(each)))
    out = np.empty(int(ranges[-1]), np.uint64)
    full = counts >= size
    if full.any():
        every = runs(hashes, size)
        docs = np.flatnonzero(full)
        into = np.arange(int(each[docs].sum()))
        base = np.repeat(np.concatenate(([0], np.cumsum(each[docs])[:-1])), each[docs])
        within = into - base
        out[np.repeat(ranges[docs], each[docs]) + within] = every[np.repeat(bounds[docs], each[docs]) + within]
    for d in np.flatnonzero((counts > 0) & ~full):
        own = hashes[bounds[d] : bounds[d + 1]]
        out[ranges[d]] = mix(np.array([int((own * _ORDER[: len(own)]).sum(dtype=np.uint64)) ^ (len(own) << 56)], np.uint64))[0]
    return out, ranges


def distinct(values: np.ndarray, ranges: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct values of each document."""
    return [np.unique(values[ranges[d] : ranges[d + 1]]) for d in range(len(ranges) - 1)]
