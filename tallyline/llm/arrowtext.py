"""Texts of Arrow batches as byte arrays, and hashes of their words and shingles.

A batch is walked in slices of about 256 KB, so the 64-bit arrays derived from its bytes
stay small whatever the batch holds. All arithmetic is modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18
U64 = np.uint64
_random = np.random.Generator(np.random.PCG64(20240229))
BYTE_CODE = _random.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_CODE = BYTE_CODE[LOWER]
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)
SHINGLE_CODE = _random.integers(1, 2**63, 16, dtype=np.uint64) * U64(2) + U64(1)
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``size`` powers of the base and of its inverse."""
    if len(_powers[0]) < size:
        for which, base in enumerate((BASE, INVERSE)):
            steps = np.full(max(size, SLICE_BYTES * 2), base, dtype=np.uint64)
            steps[0] = 1
            _powers[which] = np.multiply.accumulate(steps)
    return _powers[0][:size], _powers[1][:size]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def running_code(data: np.ndarray, code: np.ndarray = BYTE_CODE) -> np.ndarray:
    """Prefix sums g of the coded bytes; ``(g[j] - g[i]) * inverse**i`` identifies data[i:j]."""
    g = np.empty(len(data) + 1, dtype=np.uint64)
    g[0] = 0
    np.cumsum(code[data] * powers(len(data))[0], out=g[1:])
    return g


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offset of each row; null counts as empty.

    Python workers serve one step after another: what earlier batches left in Arrow's pool goes back first.
    """
    pa.default_memory_pool().release_unused()
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    _, places, data = column.buffers()
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if places is None or len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(places, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, target: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows with about ``target`` bytes together."""
    data, offsets = column_bytes(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = int(np.searchsorted(offsets, offsets[row] + target, "right")) - 1
        stop = min(max(stop, row + 1), rows)
        yield row, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def _words(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word; no word crosses a cut."""
    inside = IS_WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    g = running_code(data, LOWER_CODE)
    spelled = (g[stop] - g[start]) * powers(len(data) + 1)[1][start]
    return start, mixed(spelled + (stop - start).astype(np.uint64) * U64(BASE))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and for each row the index of its first word (one more at the end).

    Words are runs of bytes outside space and 0x09-0x0D, with A-Z lowered. A text far beyond
    a slice is worked off in parts cut at a separator.
    """
    if len(data) <= 4 * SLICE_BYTES:
        start, hashes = _words(data, offsets)
        return hashes, np.searchsorted(start, offsets)
    hashes, counts = [], [0]
    for row in range(len(offsets) - 1):
        at, end, found = int(offsets[row]), int(offsets[row + 1]), 0
        while at < end:
            stop = min(at + SLICE_BYTES, end)
            while stop < end and IS_WORD[data[stop]]:
                step = ~IS_WORD[data[stop : stop + SLICE_BYTES]]
                stop = stop + int(np.argmax(step)) if step.any() else min(stop + SLICE_BYTES, end)
            hashes.append(_words(data[at:stop], np.empty(0, np.int64))[1])
            found += len(hashes[-1])
            at = stop
        counts.append(counts[-1] + found)
    return np.concatenate(hashes) if hashes else np.empty(0, np.uint64), np.array(counts)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """For each row its sorted distinct shingle hashes; a shorter text is one shingle, no words none."""
    words, bounds = word_hashes(data, offsets)
    whole = max(len(words) - width + 1, 0)
    joined = np.zeros(whole, dtype=np.uint64)
    for i in range(width):
        joined += words[i : i + whole] * SHINGLE_CODE[i]
    joined = mixed(joined + U64(width))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= width:
            yield np.unique(joined[a : b - width + 1])
        elif b > a:
            short = (words[a:b] * SHINGLE_CODE[: b - a]).sum(dtype=np.uint64)
            yield mixed(np.array([short + U64(b - a)], dtype=np.uint64))
        else:
            yield np.empty(0, np.uint64)
