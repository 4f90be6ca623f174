"""Words of Arrow string columns as numpy arrays, computed over the bytes of a batch at once.

A word is a longest run of bytes other than blank, tab, line feed, vertical tab, form feed and carriage
return. All of these are ASCII, so the bytes of a UTF-8 text split exactly as its characters do.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_MIX1, _MIX2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D
_BLOCK = 1 << 20

_is_space = np.zeros(256, bool)
_is_space[[32, 9, 10, 11, 12, 13]] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


_byte_value = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, up to n."""
    if len(_powers[0]) <= n:
        size = max(n + 1, _BLOCK + 4096)
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


@dataclass
class Words:
    """Words of some texts: `hash[bounds[i]:bounds[i + 1]]` are those of text i, in order; `start` and `end`
    are byte positions in `data`."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray


def text_slices(column: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, byte offsets) of runs of whole texts of about `limit` bytes; null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(max(end, first + 1), len(column))
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> Words:
    """Positions and 64-bit hashes of the words; with `lower`, A-Z count as a-z."""
    n = len(data)
    solid = ~_is_space[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], solid[:-1])) if n else solid
    after = np.concatenate((solid[1:], [False])) if n else solid
    start = np.flatnonzero(solid & (~before | edge[:-1]))
    end = np.flatnonzero(solid & (~after | edge[1:])) + 1
    value = _byte_value[_lower[data] if lower else data]
    hashes = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):  # in blocks cut between words, so that the tables of powers stay small
        base = start[at]
        stop = max(int(np.searchsorted(start, base + _BLOCK)), at + 1)
        power, inverse = _power_tables(int(end[stop - 1] - base) + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value[base:end[stop - 1]] * power[:end[stop - 1] - base], dtype=np.uint64)))
        s, e = start[at:stop] - base, end[at:stop] - base
        hashes[at:stop] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64) * _GOLD)
        at = stop
    return Words(data, start, end, hashes, np.searchsorted(start, offsets))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words of one text; with fewer words, of all of them as one run."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.uint64)
    width = min(n, size)
    runs = np.zeros(n - width + 1, np.uint64)
    for i in range(width):
        runs = mix(runs * _GOLD + hashes[i:n - width + 1 + i] + np.uint64(i + 1))
    return np.unique(runs)
