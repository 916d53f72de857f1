"""Arrow text columns as flat byte arrays: words, hashes and shingles without a Python loop per row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = (np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and the offsets of the rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of runs of rows of about ``limit`` bytes; a longer row is a run of its own."""
    data, offsets = flat(column)
    rows, at = len(offsets) - 1, 0
    while at < rows:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), rows)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def mixed(h: np.ndarray) -> np.ndarray:
    """Hashes with all bits stirred (the finalizer of a 64-bit murmur hash)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, PIECE_BYTES + 1)
        up, down = np.full(size, _BASE), np.full(size, _INVERSE)
        up[0] = down[0] = 1
        _powers = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return _powers


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, from prefix sums of a polynomial in the position."""
    up, down = _powers_to(len(data) + 1)
    prefix = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=prefix[1:])
    length = (ends - starts).astype(np.uint64)
    return mixed((prefix[ends] - prefix[starts]) * down[starts] + length * np.uint64(0xD6E8FEB86659FD93))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs without white space (space, tab to carriage return), and each row's first word."""
    inside = ~_SPACE[data]
    first, last = inside.copy(), inside.copy()
    if len(data):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        bounds = np.unique(offsets)
        heads, tails = bounds[bounds < len(data)], bounds[bounds > 0] - 1
        first[heads] = inside[heads]
        last[tails] = inside[tails]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct word shingles of each row, sorted within the row, and the rows' offsets.

    A-Z count as a-z. A row with fewer words than ``width`` has its word sequence as the only
    shingle; one without words has none.
    """
    data = LOWER[data]
    starts, ends, first = words(data, offsets)
    h = span_hashes(data, starts, ends)
    counts = np.diff(first)
    rows = len(counts)
    full = np.zeros(max(len(h) - width + 1, 0), dtype=np.uint64)
    for j in range(width):
        full = full * np.uint64(0x9FB21C651E98DF25) + h[j : j + len(full)]
    full = mixed(full)
    n = np.where(counts >= width, counts - width + 1, (counts > 0).astype(counts.dtype))
    bounds = np.concatenate(([0], np.cumsum(n)))
    out = np.empty(bounds[-1], dtype=np.uint64)
    sizes = np.zeros(rows, dtype=np.int64)
    for i in range(rows):
        lo, at = bounds[i], first[i]
        if counts[i] >= width:
            own = np.sort(full[at : at + n[i]])
        elif counts[i]:
            value = np.uint64(counts[i])
            with np.errstate(over="ignore"):
                for x in h[at : at + counts[i]]:
                    value = value * np.uint64(0xA24BAED4963EE407) + x
            own = mixed(np.array([value], dtype=np.uint64))
        else:
            continue
        keep = np.ones(len(own), dtype=bool)
        np.not_equal(own[1:], own[:-1], out=keep[1:])
        own = own[keep]
        sizes[i] = len(own)
        out[lo : lo + len(own)] = own
    ends_ = np.concatenate(([0], np.cumsum(sizes)))
    keep = np.arange(bounds[-1]) - np.repeat(bounds[:-1], n) < np.repeat(sizes, n)
    return out[keep], ends_
