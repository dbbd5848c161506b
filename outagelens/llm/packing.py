"""Packing documents into windows by combinations of lengths that fill one exactly."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outagelens.llm import text_arrays, tokens
from outagelens.llm.shared import stored


@dataclass(frozen=True)
class Windows:
    """``size`` ids to a window. A combination is up to ``depth`` pieces of one length and
    one piece of the length that fills the window; ``sweeps`` passes solve for the counts."""

    size: int = 2048
    depth: int = 16
    sweeps: int = 40


def combinations(size: int, depth: int) -> np.ndarray:
    """Rows (length, times, filler) with length * times + filler = size, each mix once."""
    rows = [
        (length, times, size - length * times)
        for times in range(1, depth + 1)
        for length in range(1, (size - 1) // times + 1)
        if times > 1 or length >= size - length
    ]
    return np.array(rows, dtype=np.int64)


def _uses(row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    length, times, filler = row
    if length == filler:
        return np.array([length]), np.array([times + 1])
    return np.array([length, filler]), np.array([times, 1])


def repeat_counts(histogram: np.ndarray, rows: np.ndarray, sweeps: int) -> np.ndarray:
    """How often to use each combination: non-negative least squares against the histogram.

    Coordinate descent: a combination's count moves by what its lengths still lack, in the
    least squares sense, never below zero. ``histogram[n]`` counts pieces of length n.
    Combinations with a length that no piece has are left out from the start.
    """
    have = [(k, *map(np.ndarray.tolist, _uses(row))) for k, row in enumerate(rows)
            if histogram[row[0]] and histogram[row[2]]]
    lack = histogram.astype(np.float64).tolist()
    counts = [0.0] * len(rows)
    for _ in range(sweeps):
        moved = 0.0
        for k, lengths, times in have:
            wanted = sum(lack[n] * t for n, t in zip(lengths, times, strict=True)) / sum(t * t for t in times)
            step = max(wanted, -counts[k])
            counts[k] += step
            for n, t in zip(lengths, times, strict=True):
                lack[n] -= step * t
            moved = max(moved, abs(step))
        if moved < 0.01:
            break
    return np.array(counts)


def plan(histogram: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray, int]:
    """Which sequence each piece of a length goes to, and what is left over.

    Returns slots (length, first rank, end rank, first sequence, offset), ordered by length
    and rank: a piece whose rank among those of its length lies in a slot goes to the
    sequence that many further on. Then the number of pieces of each length that no
    combination takes, and the number of sequences.
    """
    rows = combinations(windows.size, windows.depth)
    counts = repeat_counts(histogram, rows, windows.sweeps)
    left = histogram.copy()
    used = np.zeros_like(histogram)
    slots, sequences = [], 0
    for k in np.argsort(-counts, kind="stable"):
        lengths, times = _uses(rows[k])
        repeat = int(min(round(counts[k]), (left[lengths] // times).min()))
        if repeat <= 0:
            continue
        offset = 0
        for length in [*[rows[k][0]] * int(rows[k][1]), rows[k][2]]:
            slots.append((length, used[length], used[length] + repeat, sequences, offset))
            used[length] += repeat
            left[length] -= repeat
            offset += int(length)
        sequences += repeat
    slots.sort()
    return np.array(slots, dtype=np.int64).reshape(-1, 5), left, sequences


def _tails(total: int, size: int) -> np.ndarray:
    """Ends of the windows of a stream of ids: full ones, then powers of two, so no padding."""
    rest, ends = total % size, [total - total % size]
    while rest:
        step = 1 << (rest.bit_length() - 1)
        ends.append(ends[-1] + step)
        rest -= step
    return np.array(ends[1:], dtype=np.int64)


def _ranked(rows: DataFrame, path: str, end_id: int, windows: Windows) -> DataFrame:
    """Ids of each document, with ranks within its task: of its rest's length among those,
    and of its full windows."""
    size = windows.size

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = tokens.encoder(path), TaskContext.get().partitionId()
        ranks, fulls = np.zeros(size, dtype=np.int64), 0
        for batch in text_arrays.slices(batches):
            out = []
            for ids in own.rows(batch.column("body")):
                ids = np.append(ids, np.uint32(end_id))
                rest = len(ids) % size
                out.append((len(ids), rest, int(ranks[rest]), fulls, tokens.packed(ids)))
                ranks[rest] += 1
                fulls += len(ids) // size
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.full(len(out), part, np.int32)),
                 *[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.binary())],
                names=["id", "part", "n", "rest", "rank", "fulls", "ids"])

    return stored(rows.mapInArrow(work, "id long, part int, n long, rest long, rank long, fulls long, ids binary"))


def _pieces(slots: np.ndarray, left: np.ndarray, full: int, filled: int, windows: Windows):
    """Cuts documents: full windows first, then the rest where the plan puts it."""
    size = windows.size
    begin = np.searchsorted(slots[:, 0], np.arange(size + 1))
    placed = np.bincount(slots[:, 0], weights=slots[:, 2] - slots[:, 1], minlength=size).astype(np.int64)
    lengths = np.arange(size)
    stream = np.cumsum(left * lengths) - left * lengths
    total = int((left * lengths).sum())
    tails = _tails(total, size)

    def stream_pieces(at: int, n: int) -> Iterator[tuple[int, int, int]]:
        """(sequence, offset, length) of n ids that begin at a place of the left-over ids."""
        while n:
            if at < total - total % size:
                window, start, end = at // size, at // size * size, at // size * size + size
            else:
                k = int(np.searchsorted(tails, at, side="right"))
                window, start, end = total // size + k, int(tails[k - 1]) if k else total - total % size, int(tails[k])
            step = min(n, end - at)
            yield full + filled + window, at - start, step
            at, n = at + step, n - step

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_arrays.slices(batches):
            out = []
            for row in batch.to_pylist():
                ids = tokens.unpacked(row["ids"])
                data = memoryview(tokens.crc_bytes(ids))

                def piece(start, length, sequence, offset, row=row, data=data):
                    crc = zlib.crc32(data[4 * start : 4 * (start + length)])
                    out.append((row["id"], start, length, crc, row["n"], sequence, offset))

                for k in range(row["n"] // size):
                    piece(k * size, size, row["full"] + k, 0)
                rest, rank, start = row["rest"], row["rank"], row["n"] - row["rest"]
                if not rest:
                    continue
                if rank < placed[rest]:
                    own = slots[begin[rest] : begin[rest + 1]]
                    slot = own[np.searchsorted(own[:, 1], rank, side="right") - 1]
                    piece(start, rest, full + int(slot[3]) + rank - int(slot[1]), int(slot[4]))
                else:
                    at = int(stream[rest]) + (rank - int(placed[rest])) * rest
                    for sequence, offset, length in stream_pieces(at, rest):
                        piece(start, length, sequence, offset)
                        start += length
            columns = list(zip(*out, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                             names=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
    return work


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, windows: Windows = Windows(),
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: the document's ids it holds and its place in a sequence.

    Columns: the id, start, length, ids_crc32, doc_tokens, sequence_id, offset. Every
    document's ids end in ``end_id``. Full windows of a document are sequences of their own.
    The lengths of what remains form a histogram of fewer rows than a window has ids; on the
    driver, counts of combinations that fill a window are fitted to it and rounded down to
    what there is. What no combination takes is packed greedily, end to end, and cut at the
    ends of windows; the last ids go to sequences of powers of two. So no sequence is padded,
    and only left-over documents are cut.

    A piece finds its place from its rank among those of its length: its rank in its task,
    and the counts of the tasks before. No length gathers in a task.

    Defined results: a null text is empty, and its document is the end id alone. Rows that
    share an id are packed each; null ids are kept. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("body"))
    ranked = _ranked(rows, tokenizer, end_id, windows)
    counts = ranked.groupBy("part", "rest").agg(F.count(F.lit(1)).alias("n"), F.sum(F.floor(F.col("n") / windows.size)).alias("full"))
    histogram = np.zeros(windows.size, dtype=np.int64)
    full = 0
    for row in counts.groupBy("rest").agg(F.sum("n").alias("n"), F.sum("full").alias("full")).collect():
        full += row["full"]
        if row["rest"]:
            histogram[row["rest"]] = row["n"]
    slots, left, filled = plan(histogram, windows)
    before = W.partitionBy("rest").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = counts.groupBy("part").agg(F.sum("full").alias("full"))
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per task
    offsets = (
        counts.withColumn("rank_before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n", "full")
        .join(parts.select("part", F.coalesce(F.sum("full").over(earlier), F.lit(0)).alias("full_before")), "part")
    )
    placed = ranked.join(offsets, ["part", "rest"]).select(
        "id", "n", "rest", (F.col("rank") + F.col("rank_before")).alias("rank"),
        (F.col("fulls") + F.col("full_before")).alias("full"), "ids")
    pieces = placed.mapInArrow(
        _pieces(slots, left, full, filled, windows),
        "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return pieces.select(F.col("id").alias(id_col), *pieces.columns[1:])
