"""Batches of texts as flat bytes, in stretches of bounded size: a longer text is cut between its words.

Operators that gather something per text (counts, sets) add up over the stretches of a row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from . import textbytes

STRETCH_BYTES = 1 << 20


Fits = Callable[[np.ndarray], np.ndarray]


def _cut(fits: Fits, data: np.ndarray, at: int, limit: int) -> int:
    """The last place up to ``at + limit`` after which a new stretch may begin, else the first one found beyond."""
    places = np.flatnonzero(fits(data[at : at + limit]))
    if len(places):
        return at + int(places[-1]) + 1
    for low in range(at + limit, len(data), limit):
        places = np.flatnonzero(fits(data[low : low + limit]))
        if len(places):
            return low + int(places[0]) + 1
    return len(data)


def stretches(
    column: pa.Array, fits: Fits, limit: int = STRETCH_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)``; ``fits`` marks, in a run of bytes, those after which a text may be cut.

    A row longer than ``limit`` comes as several runs of this one row. Only a row without such places stays whole.
    """
    for lo, hi, data, offsets in textbytes.pieces(column, limit):
        if hi - lo > 1 or len(data) <= limit:
            yield lo, hi, data, offsets
            continue
        at = 0
        while at < len(data):
            end = len(data) if len(data) - at <= limit else _cut(fits, data, at, limit)
            yield lo, hi, data[at:end], np.array([0, end - at])
            at = end


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of marked bytes within rows, and each row's first run."""
    first, last = inside.copy(), inside.copy()
    if len(inside):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        heads = offsets[offsets < len(inside)]
        tails = offsets[offsets > 0] - 1
        first[heads] = inside[heads]
        last[tails] = inside[tails]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)
