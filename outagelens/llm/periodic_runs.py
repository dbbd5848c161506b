"""Periodic runs of words: found by uniting suffix classes in order of falling common prefix."""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outagelens.llm import text_arrays

WORD = r"[^\x20\x09-\x0D]+"
RUN = "struct<start: long, length: long, period: long>"
#: sets up to so many positions are inserted one by one, larger ones merged as a whole
_INSERTED = 32


@dataclass(frozen=True)
class Repeats:
    """A run has at least ``min_length`` words and ``min_exponent`` (2 or more) periods."""

    min_length: int = 6
    min_exponent: int = 4

    def least_prefix(self) -> int:
        """Two places one period apart share at least so many words, whatever the period."""
        periods = range(1, max(self.min_length, 1) + 1)
        return max(1, min(max(self.min_length, self.min_exponent * q) - q for q in periods))


def _suffix_order(codes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places in the order of the words that follow them, and ranks by the first 1, 2, 4 ... words.

    Equal ranks at level j mean that the next 2**j words are equal and of one row. Only places
    that still share a rank are sorted again.
    """
    n = len(codes)
    ends = np.searchsorted(rows, rows, side="right")
    order = np.lexsort((codes, rows))
    fresh = np.append(True, (codes[order[1:]] != codes[order[:-1]]) | (rows[order[1:]] != rows[order[:-1]]))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    levels, reach = [rank], 1
    while True:
        slots = np.flatnonzero(~fresh | np.append(~fresh[1:], False))
        if not len(slots):
            return order, levels
        own = order[slots]
        follow = np.where(own + reach < ends[own], rank[np.minimum(own + reach, n - 1)], -1)
        key = rank[own] * (n + 1) + follow + 1
        by = np.argsort(key, kind="stable")
        own, key = own[by], key[by]
        order[slots] = own
        fresh[slots[1:]] |= key[1:] != key[:-1]
        rank = rank.copy()
        rank[own] = np.maximum.accumulate(np.where(fresh[slots], slots, 0))
        levels.append(rank)
        reach *= 2


def _common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Words that each place shares with the one before it in the order; the first has none."""
    low, high = order[:-1], order[1:]
    shared = np.zeros(len(order), dtype=np.int64)
    near = np.flatnonzero(levels[0][low] == levels[0][high])
    low, high = low[near], high[near]
    length = np.zeros(len(near), dtype=np.int64)
    for level in range(len(levels) - 1, -1, -1):
        rank = np.append(levels[level], -1)
        length += (rank[low + length] == rank[high + length]).astype(np.int64) << level
    shared[near + 1] = length
    return shared


def _newly_adjacent(order: np.ndarray, shared: np.ndarray, least: int, times: int) -> Iterator[tuple[int, int, int]]:
    """(place, next place, common words) whenever two places become neighbours in one class.

    Classes start as single places; the pairs that share most words are united first, the
    smaller set into the larger. Only pairs are yielded whose distance, ``times`` over, lies
    within the words they share.
    """
    edges = np.flatnonzero(shared >= least)
    edges = edges[np.argsort(-shared[edges], kind="stable")]
    parent = list(range(len(order)))
    places: dict[int, list[int]] = {}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    where = order.tolist()
    for edge, common in zip(edges.tolist(), shared[edges].tolist(), strict=True):
        a, b = root(edge - 1), root(edge)
        large = places.pop(a, None) or [where[edge - 1]]
        small = places.pop(b, None) or [where[edge]]
        if len(large) < len(small):
            large, small, a, b = small, large, b, a
        parent[b] = a
        widest = common // times
        last = len(small) - 1
        for k, place in enumerate(small):
            at = bisect.bisect_left(large, place)
            if at and place - large[at - 1] <= widest and (k == 0 or small[k - 1] < large[at - 1]):
                yield large[at - 1], place, common
            if at < len(large) and large[at] - place <= widest and (k == last or small[k + 1] > large[at]):
                yield place, large[at], common
        if len(small) <= _INSERTED:
            for place in small:
                bisect.insort(large, place)
        else:
            large += small
            large.sort()
        places[a] = large


def find_runs(codes: np.ndarray, offsets: np.ndarray, repeats: Repeats = Repeats()) -> np.ndarray:
    """(row, start, length, period) of every run, by row, start, period.

    ``codes`` are the 64-bit word codes of all rows, ``offsets`` the words between rows; a
    start counts from its row. A run is a stretch with a smallest period that neither
    neighbouring word extends. Its start and the place one period on share all words up to
    its end, and no place between them shares as many; so they become neighbours just when
    their classes are united at that number, and each run is found once.
    """
    none = np.zeros((0, 4), dtype=np.int64)
    least, n = repeats.least_prefix(), len(codes)
    if n <= least:
        return none
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    grams = rows[: n - least + 1].astype(np.uint64)
    for k in range(least):
        grams = text_arrays.mix(grams + codes[k : n - least + 1 + k])
    in_order = np.sort(grams)
    twice = in_order[1:][in_order[1:] == in_order[:-1]]
    if not len(twice):
        return none
    at = np.searchsorted(twice, grams).clip(max=len(twice) - 1)
    able = np.zeros(len(offsets) - 1, dtype=bool)
    able[rows[: len(grams)][twice[at] == grams]] = True
    chosen = np.flatnonzero(able[rows])  # rows without a repeated stretch of that length have no run
    codes, rows = codes[chosen], rows[chosen]
    order, levels = _suffix_order(codes, rows)
    shared = _common_prefixes(order, levels)
    times = repeats.min_exponent - 1
    found = np.array(list(_newly_adjacent(order, shared, least, times)), dtype=np.int64).reshape(-1, 3)
    first, second, common = found.T
    period = second - first
    before = np.maximum(first - 1, 0)
    starts_row = (first == 0) | (rows[before] != rows[first])
    leftmost = starts_row | (codes[before] != codes[np.maximum(second - 1, 0)])
    keep = leftmost & (common + period >= repeats.min_length)
    first, common, period = first[keep], common[keep], period[keep]
    row = rows[first]
    start = first - np.searchsorted(rows, row)
    out = np.column_stack([row, start, common + period, period])
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _collapsed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, n_rows: int,
               kept: np.ndarray) -> pa.Array:
    """The kept words of each row, one space between them."""
    starts, ends, rows = starts[kept], ends[kept], rows[kept]
    sizes = ends - starts + 1
    if len(rows):
        sizes[np.append(rows[1:] != rows[:-1], True)] -= 1
    stops = np.cumsum(sizes)
    edges = np.zeros(len(data) + 1, dtype=np.int8)
    edges[starts] += 1
    edges[ends] -= 1
    out = np.full(int(stops[-1]) if len(stops) else 0, 32, dtype=np.uint8)
    letters = np.ones(len(out), dtype=bool)
    letters[(stops - 1)[sizes == ends - starts + 1]] = False
    out[letters] = data[np.cumsum(edges[:-1], dtype=np.int8).view(bool)]
    bounds = np.append(0, stops)[np.searchsorted(rows, np.arange(n_rows + 1))]
    return pa.LargeStringArray.from_buffers(n_rows, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())


def _work(repeats: Repeats):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_arrays.slices(batches):
            for low, high, data, offsets in text_arrays.row_groups(batch.column("body")):
                starts, ends, rows = text_arrays.words(data, offsets)
                counts = np.bincount(rows, minlength=high - low)
                bounds = np.append(0, np.cumsum(counts))
                runs = find_runs(text_arrays.hash_spans(data, starts, ends), bounds, repeats)
                edges = np.zeros(len(starts) + 1, dtype=np.int64)
                np.add.at(edges, bounds[runs[:, 0]] + runs[:, 1] + runs[:, 3], 1)
                np.add.at(edges, bounds[runs[:, 0]] + runs[:, 1] + runs[:, 2], -1)
                kept = np.cumsum(edges[:-1]) == 0
                lists = np.searchsorted(runs[:, 0], np.arange(high - low + 1)).astype(np.int32)
                fields = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in (1, 2, 3)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(low, high - low), pa.array(counts.astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(lists), fields),
                     _collapsed(data, starts, ends, rows, high - low, kept)],
                    names=["id", "n_words", "runs", "collapsed"])
    return work


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repeats: Repeats = Repeats()) -> DataFrame:
    """One row per row of ``docs``: its id, n_words, runs and collapsed text.

    Words are runs of characters other than the six ASCII separators. ``runs`` lists start
    (word number), length and period of every run by start, then period. ``collapsed`` keeps,
    one space between them, the words that no run contains after its first period. Each row
    is worked on by itself, so nothing is shuffled and no key can be hot; memory follows the
    longest text (some ten numbers a word, and one more for each doubling of its longest
    repeat). Words are compared by 64-bit hashes.

    Defined results: a null, empty or blank text has no words, no runs and an empty collapsed
    text. Null and repeated ids are kept as they are; other columns are ignored; an empty table
    gives none.
    """
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("body"))
    found = rows.mapInArrow(_work(repeats), f"id {kind}, n_words long, runs array<{RUN}>, collapsed string")
    return found.withColumnRenamed("id", id_col)


def with_periodic_tail(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts of about a tenth of the ids get a tail that repeats, for tests of the search.

    With h the CRC-32 of the decimal id, g = h // 10 and n words, a text with h % 10 = 0 keeps
    its words before a = g % n; those from there on repeat the first 1 + (n - a) // (3 + g % 8)
    of them. Such a text has single spaces afterwards. All other texts stay, and so do null
    texts, texts without words, and rows with a null id.
    """
    h = F.crc32(F.col(id_col).cast("string"))
    g = F.floor(h / 10)
    damaged = docs.withColumn("_w", F.when(h % 10 == 0, F.regexp_extract_all(text_col, F.lit(WORD), F.lit(0))))
    n = F.size("_w")
    a = F.try_mod(g, n.cast("long")).cast("int")
    period = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    repeated: Column = F.flatten(F.array_repeat(F.slice("_w", a + 1, period), F.ceil((n - a) / period).cast("int")))
    tailed = F.concat(F.slice("_w", F.lit(1), a), F.slice(repeated, F.lit(1), n - a))
    return damaged.withColumn(
        text_col, F.when(F.size("_w") > 0, F.array_join(tailed, " ")).otherwise(F.col(text_col))).drop("_w")
