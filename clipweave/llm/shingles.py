"""Word shingles of whole texts as 64-bit hashes, for batches of texts in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_RNG = np.random.Generator(np.random.PCG64(0x5EED))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = _BYTE[_LOWER]
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
#: Bytes of text that are worked on at once (a longer text is worked on alone).
CHUNK = 1 << 19


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS = np.multiply.accumulate(np.full(256, _ODD))


#: What tells the words of a shingle apart.
_PLACES = np.arange(1, 65, dtype=np.uint64) * _ODD


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if n > len(_POWERS):
        _POWERS = np.multiply.accumulate(np.full(1 << int(n).bit_length(), _ODD))
    return _POWERS


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """data: bytes of texts end to end, bounds: their starts and the last end. Hashes of all words; the texts' first words' indices and the last end."""
    solid = ~_BLANK[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    at_bound = bounds[:-1][bounds[:-1] < len(data)]
    begins[at_bound] = solid[at_bound]
    at = np.flatnonzero(solid)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    opens = begins[at]
    first = np.flatnonzero(opens)
    starts = at[first]
    inside = at - np.repeat(starts, np.diff(first, append=len(at)))
    values = _VALUE[data[at]] * _powers(int(inside.max()) + 1)[inside]
    return mixed(np.add.reduceat(values, first)), np.searchsorted(starts, bounds)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, n: int) -> list[np.ndarray]:
    """The sorted distinct n-word shingles of each text; the whole sequence where it has fewer words."""
    words, first = word_hashes(data, bounds)
    size = len(words)
    grams = np.zeros(size, np.uint64)
    for j in range(n):
        k = max(0, size - j)
        grams[:k] += mixed(words[j:] + _PLACES[j]) if k else 0
    grams = mixed(grams)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            s = grams[a : b - n + 1].copy()
            s.sort()
            if len(s) > 1:
                keep = np.empty(len(s), bool)
                keep[0] = True
                np.not_equal(s[1:], s[:-1], out=keep[1:])
                s = s[keep]
            out.append(s)
        elif b > a:
            places = np.arange(1, b - a + 1, dtype=np.uint64) * _ODD
            out.append(mixed(np.add.reduce(mixed(words[a:b] + places), keepdims=True) + np.uint64(b - a)))
        else:
            out.append(words[:0])
    return out


def chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """A string column as (first row, bytes, bounds) chunks; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, side="right")) - 1)
        end = min(end, len(column))
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def all_sets(column: pa.Array, n: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    for row, data, bounds in chunks(column):
        yield row, shingle_sets(data, bounds, n)


def slices(batch: pa.RecordBatch, *columns: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about so many bytes of the columns, whole rows each."""
    size = sum(batch.column(c).nbytes for c in columns)
    rows = max(1, int(batch.num_rows * most / max(1, size)))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
