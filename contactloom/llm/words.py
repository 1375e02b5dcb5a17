"""Words of whole Arrow columns as 64-bit numbers, without a Python loop per word.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D, which in UTF-8 is the same as
``[^\\x20\\x09-\\x0D]+`` over characters. Texts are handled in slices of a few megabytes, so
memory follows the slice (or the longest single text), not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20

_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


class Words(NamedTuple):
    """Words of several texts: ``first[i]:first[i + 1]`` are the words of text ``i``."""

    data: np.ndarray  # bytes of all texts
    starts: np.ndarray  # byte offsets into data
    ends: np.ndarray
    first: np.ndarray
    offsets: np.ndarray  # byte offsets of the texts
    hashes: np.ndarray  # uint64

    def text_of(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of them."""
    size = 1 << max(16, int(n).bit_length())
    if size not in _powers:
        _powers.clear()
        tables = []
        for base in (_BASE, _BASE_INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        _powers[size] = tuple(tables)
    return _powers[size]


def mix(h: np.ndarray) -> np.ndarray:
    """Finishing steps of a 64-bit hash, so that every bit depends on all."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(
        0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def split_words(column: pa.Array, lower: bool = False) -> Words:
    """Words of a string column; ``lower`` turns A-Z, and nothing else, to small letters."""
    data, offsets = text_buffer(column)
    if lower:
        data = _LOWER[data]
    starts, ends = word_bounds(data, offsets)
    return Words(data, starts, ends, np.searchsorted(starts, offsets), offsets,
                 hash_words(data, starts, ends))


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~_SPACE[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    begins[cuts] = inside[cuts]
    stops[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
               step: int = 1 << 19) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        low = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, low + step, "right")))
        high = int(ends[j - 1])
        powers, inverse = power_tables(high - low + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_BYTE[data[low:high]] * powers[:high - low], out=sums[1:])
        a, b = starts[i:j] - low, ends[i:j] - low
        out[i:j] = mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64))
        i = j
    return out


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` numbers; the caller drops runs that cross texts."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out *= _BASE
        out += h[j:j + n]
    return mix(out)


def long_window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """As ``window_hashes`` by running sums, for wide windows."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    powers, inverse = power_tables(len(h))
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * powers[:len(h)], out=sums[1:])
    return mix((sums[width:] - sums[:n]) * inverse[:n])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:-step] if step else out, out[step:])
        done += step
    return out


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES
           ) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch whose texts have about ``limit`` bytes; one text is never split."""
    if not batch.num_rows:
        return
    _, offsets = text_buffer(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
