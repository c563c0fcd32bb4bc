"""Words of whole Arrow text columns as numpy arrays: byte places and 64-bit hashes, without an object per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


@dataclass
class Words:
    """Rows ``first`` .. ``first + len(ptr) - 1`` of a column; row r has words ``ptr[r] : ptr[r + 1]``."""

    first: int
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    ptr: np.ndarray


def _plain(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    return at, np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)


def words(column: pa.Array, lower: bool = False, limit: int = 1 << 20) -> Iterator[Words]:
    """Runs of rows of about ``limit`` bytes; a longer text is a run of its own. Null is an empty text."""
    if len(column) == 0:
        return
    at, data = _plain(column)
    row, n = 0, len(column)
    while row < n:
        stop = max(row + 1, int(np.searchsorted(at, at[row] + limit, "right")) - 1)
        yield _run(row, data[at[row]: at[stop]], at[row: stop + 1] - at[row], lower)
        row = stop


def _run(first: int, data: np.ndarray, at: np.ndarray, lower: bool) -> Words:
    size = len(data)
    if lower:
        data = LOWER[data]
    # One spare place at either end makes every edge of a row an edge of a word.
    inside = np.zeros(size + 1, dtype=bool)
    inside[:size] = ~IS_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cut = at[:-1][at[:-1] < size]
    begins[cut] = inside[cut]
    start = np.flatnonzero(begins)
    ends = np.zeros(size + 1, dtype=bool)
    ends[1:] = inside[:-1] & ~inside[1:]
    cut = at[1:][at[1:] > 0]
    ends[cut] |= inside[cut - 1]
    end = np.flatnonzero(ends)
    scale = powers(BASE, size)
    total = np.zeros(size + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * scale, out=total[1:])
    back = powers(INVERSE, size)
    value = (total[end] - total[start]) * back[start] if len(start) else np.zeros(0, np.uint64)
    value = mix(value ^ ((end - start).astype(np.uint64) << np.uint64(48)))
    return Words(first, data, start, end, value, np.searchsorted(start, at))


def grams(value: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` word hashes; one for the whole sequence where it has fewer words."""
    m = min(n, len(value))
    if m == 0:
        return np.zeros(0, np.uint64)
    out = np.full(len(value) - m + 1, np.uint64(m), dtype=np.uint64)
    for k in range(m):
        out = (out ^ value[k: len(value) - m + 1 + k]) * BASE
        out ^= out >> np.uint64(29)
    return mix(out)
