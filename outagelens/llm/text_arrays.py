"""Text columns as flat byte arrays: rows, words and word hashes without string objects."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: the six bytes that separate words
WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: bytes that one step of the array code looks at; only a single longer row exceeds it
GROUP_BYTES = 1 << 18
#: rows that one step of a task holds in Python besides the batch that Spark sent
SLICE_ROWS = 1_024
_PIECE = 1 << 20
_RATIO = 0x9E3779B97F4A7C15
_BYTE_CODES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of the batches in slices of few rows, so that copies of them stay small."""
    for batch in batches:
        for low in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(low, SLICE_ROWS)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows and the offsets between rows; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def groups(offsets: np.ndarray, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes, or of one row."""
    row, last = 0, len(offsets) - 1
    while row < last:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, min(end, last)
        row = min(end, last)


def row_groups(column: pa.Array, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of each group of rows."""
    data, offsets = utf8(column)
    for low, high in groups(offsets, limit):
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True that stay within one row."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    breaks = np.zeros(len(inside) + 1, dtype=bool)
    breaks[offsets] = True
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | breaks[1:-1]
    ends[:-1] &= ~inside[1:] | breaks[1:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word: a run of bytes other than the six separators."""
    starts, ends = runs(~WHITE[data], offsets)
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix finaliser)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _power_tables() -> list[np.ndarray]:
    if not _powers:
        for ratio in (_RATIO, pow(_RATIO, -1, 2**64)):
            steps = np.full(_PIECE + 1, ratio, dtype=np.uint64)
            steps[0] = 1
            _powers.append(np.cumprod(steps, dtype=np.uint64))
    return _powers


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes; spans ascend and don't overlap.

    Prefix sums of a polynomial over byte codes, so the cost is one pass over the bytes.
    Long data is taken piecewise; a span longer than a piece is hashed by its parts.
    """
    out = np.zeros(len(starts), dtype=np.uint64)
    up, down = _power_tables()
    done = 0
    while done < len(starts):
        base = int(starts[done])
        end = max(done + 1, int(np.searchsorted(ends, base + _PIECE, side="right")))
        if int(ends[done]) - base > _PIECE:
            parts = np.arange(base, int(ends[done]) + _PIECE, _PIECE).clip(max=int(ends[done]))
            parts = np.unique(parts)
            codes = hash_spans(data, parts[:-1], parts[1:])
            out[done] = np.uint64(len(codes))
            for code in codes:
                out[done : done + 1] = mix(out[done : done + 1] * np.uint64(_RATIO) + code)
            done += 1
            continue
        piece = data[base : int(ends[end - 1])]
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODES[piece] * up[: len(piece)], out=sums[1:])
        low, high = starts[done:end] - base, ends[done:end] - base
        out[done:end] = mix((sums[high] - sums[low]) * down[low] + (high - low).astype(np.uint64))
        done = end
    return out


def arrow_list(lists: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column from one array per row."""
    ends = np.zeros(len(lists) + 1, dtype=np.int32)
    np.cumsum([len(x) for x in lists], out=ends[1:])
    flat = np.concatenate(lists) if lists else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, type=kind))
