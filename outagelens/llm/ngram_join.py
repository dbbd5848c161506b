"""Documents linked by the Jaccard similarity of their word shingles."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outagelens.llm import signature_tree, text_arrays
from outagelens.llm.components import components
from outagelens.llm.shared import may_be_member, member_bits, member_place, stored


@dataclass(frozen=True)
class Shingling:
    """Sets of ``words`` consecutive words link at ``percent`` of their union or more.

    ``extra_percent``: how many more of a document's first shingles than one are held
    against other documents' before its whole set is. ``chunk_tokens``: shingles that one
    task holds of a large group.
    """

    words: int = 4
    percent: int = 85
    extra_percent: int = 6
    chunk_tokens: int = 1_000_000


_MULTIPLY = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                      0x85EBCA77C2B2AE63, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0xD6E8FEB86659FD93], dtype=np.uint64)


def _ranked_sets(
    column: pa.Array, shingling: Shingling, levels: np.ndarray | None
) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """The sorted distinct 64-bit shingles of each row, and how frequent their words are."""
    n = shingling.words
    for low, high, data, offsets in text_arrays.row_groups(column):
        data = text_arrays.LOWER[data]
        starts, ends, rows = text_arrays.words(data, offsets)
        hashes = text_arrays.hash_spans(data, starts, ends)
        own = np.zeros(len(hashes), dtype=np.uint16) if levels is None else levels[_word_cell(hashes)]
        whole = max(len(hashes) - n + 1, 0)
        sums, frequent = np.zeros(whole, dtype=np.uint64), np.zeros(whole, dtype=np.uint16)
        for k in range(n):
            sums += hashes[k : len(hashes) - n + 1 + k] * _MULTIPLY[k]
            frequent += own[k : len(hashes) - n + 1 + k]
        sums = text_arrays.mix(sums)
        first = np.searchsorted(rows, np.arange(high - low + 1))
        for row in range(high - low):
            begin, end = first[row], first[row + 1]
            if end - begin >= n and levels is None:
                yield np.unique(sums[begin : end - n + 1]), None
            elif end - begin >= n:
                tokens, at = np.unique(sums[begin : end - n + 1], return_index=True)
                yield tokens, frequent[begin : end - n + 1][at]
            elif end > begin:
                short = (hashes[begin:end] * _MULTIPLY[: end - begin]).sum(keepdims=True, dtype=np.uint64)
                yield text_arrays.mix(short + np.uint64(end - begin)), np.zeros(1, dtype=np.uint16)
            else:
                yield np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint16)


def shingle_sets(column: pa.Array, shingling: Shingling) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit shingles of each row; empty without any word."""
    for tokens, _ in _ranked_sets(column, shingling, None):
        yield tokens


def _word_cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - _CELL_BITS)).astype(np.int64)


def _word_levels(rows: DataFrame) -> np.ndarray:
    """How frequent the words of each cell are in all texts, in quarters of a doubling.

    A table of fixed size, whatever the number of words: tasks count their own words in it
    and send the cells they met, which are added up. Words that share a cell share its level;
    that only blurs an order in which any choice is right.
    """
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << _CELL_BITS, dtype=np.int64)
        for batch in batches:
            for _, _, data, offsets in text_arrays.row_groups(batch.column("body")):
                data = text_arrays.LOWER[data]
                starts, ends, _ = text_arrays.words(data, offsets)
                counts += np.bincount(_word_cell(text_arrays.hash_spans(data, starts, ends)), minlength=len(counts))
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(counts[met])], names=["cell", "n"])

    found = rows.select("body").mapInArrow(work, "cell int, n long").groupBy("cell").agg(
        F.round(4 * F.log2(F.sum("n").cast("double"))).cast("short").alias("level")).toArrow()
    levels = np.zeros(1 << _CELL_BITS, dtype=np.uint16)
    levels[found.column("cell").to_numpy()] = found.column("level").to_numpy()
    return levels


#: the table of word counts has 2**16 cells
_CELL_BITS = 16
#: sets that a task remembers so as not to send their keys again
_SEEN = 1 << 18


def _at_least(n: int, percent: int) -> int:
    return -(-n * percent // 100)


def _signatures(shingling: Shingling, levels: np.ndarray):
    """Set sizes and codes, and the first shingles of each set with the rarest words first."""
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            sizes, codes, keys = [], [], []
            named = batch.column("id").is_valid().to_pylist()
            for has_id, (tokens, frequent) in zip(named, _ranked_sets(batch.column("body"), shingling, levels), strict=True):
                size = len(tokens)
                sizes.append(size)
                code = (int(text_arrays.mix(tokens).sum(dtype=np.uint64)),
                        int(text_arrays.mix(tokens ^ _MULTIPLY[0]).sum(dtype=np.uint64)))
                codes.append(code)
                if not has_id or not size or code in seen:
                    keys.append(tokens[:0])
                    continue
                if len(seen) >= _SEEN:
                    seen.clear()  # equal sets send their keys once more, which changes nothing
                seen.add(code)
                extra = size * shingling.extra_percent // 100
                first = size - _at_least(size, shingling.percent) + 1 + extra
                keys.append(tokens[np.lexsort((tokens, frequent))[:first]])
            both = np.array(codes, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            flat = [k.view(np.int64) for k in keys]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1]),
                 text_arrays.arrow_list(flat, pa.int64())],
                names=["id", "n", "code_a", "code_b", "keys"])
    return work


def _whole_sets(rows: DataFrame, groups: DataFrame, shingling: Shingling) -> DataFrame:
    """The sets of the texts that stand in a group; the texts themselves don't move."""
    bits = member_bits(groups, "id")
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            few = batch.filter(pa.array(may_be_member(batch.column("place").to_numpy(), shared.value)))
            sets = [s.view(np.int64) for s in shingle_sets(few.column("body"), shingling)]
            yield pa.RecordBatch.from_arrays(
                [few.column("id"), text_arrays.arrow_list(sets, pa.int64())], names=["id", "tokens"])

    able = rows.filter("id is not null").select("id", "body", member_place("id", bits).alias("place"))
    return able.mapInArrow(work, "id long, tokens array<long>").join(groups, "id")


def _tile_links(percent: int):
    """Rows of a tile stand together, sorted by tile; side 0 is joined with itself unless
    there is a side 1, ``label`` says what is connected already."""

    def linked(ids: list[int], sides: list[int], labels: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
        side, known = np.array(sides), np.unique(np.array(labels, dtype=np.int64), return_inverse=True)[1]
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        a = signature_tree.Tree(sets, left)
        b = signature_tree.Tree(sets, right) if len(right) else a
        return [(ids[i], ids[j]) for i, j in signature_tree.join(a, b, sets, known, percent)]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, rows = None, ([], [], [], [])
        out: list[tuple[int, int]] = []
        for batch in batches:
            tokens = batch.column("tokens")
            ends = tokens.offsets.to_numpy()
            flat = tokens.values.to_numpy(zero_copy_only=False).view(np.uint64)
            columns = [batch.column(c).to_pylist() for c in ("tile", "id", "side", "label")]
            for k, (own, i, side, label) in enumerate(zip(*columns, strict=True)):
                if own != tile:
                    out += linked(*rows)
                    tile, rows = own, ([], [], [], [])
                for part, value in zip(rows, (i, side, label, flat[ends[k] : ends[k + 1]].copy()), strict=True):
                    part.append(value)
            yield _links(out)
            out = []
        yield _links(out + linked(*rows))

    def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        both = np.array(pairs, dtype=np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])
    return work


def _join_tiles(tiles: DataFrame, percent: int) -> DataFrame:
    return (
        tiles.select("tile", "id", "side", "label", "tokens").repartition(F.xxhash64("tile")).sortWithinPartitions("tile")
        .mapInArrow(_tile_links(percent), "a long, b long")
    )


def _need(n: Column, s: Shingling) -> Column:
    """Shingles that two linked documents, one of them of size n, have among their keys."""
    smaller = F.floor((n * s.percent + 99) / 100)
    return F.floor(smaller * s.extra_percent / 100) + 1


def _candidates(signatures: DataFrame, s: Shingling) -> tuple[DataFrame, DataFrame]:
    """(id, n, grp, tokens_sum of the group) of texts that may have a link, and classes of
    equal sets: (code_a, code_b, n, least id, rep: the least of the ids that sent keys)."""
    classes = signatures.filter("n > 0 and id is not null").groupBy("code_a", "code_b", "n").agg(
        F.min("id").alias("least"), F.min(F.when(F.size("keys") > 0, F.col("id"))).alias("rep"))
    keys = signatures.filter("id is not null").select("id", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("holders")).filter("holders > 1").select("key")
    hits = stored(keys.join(shared, "key"))
    able = (
        hits.groupBy("id").agg(F.count(F.lit(1)).alias("hits"))
        .join(signatures.filter("size(keys) > 0").select("id", "n", "code_a", "code_b"), "id")
        .filter(F.col("hits") >= _need(F.col("n"), s))
        .join(classes.select("code_a", "code_b", "n", "rep"), ["code_a", "code_b", "n"])
        .filter("id = rep").groupBy("id").agg(F.min("n").alias("n"))
    )
    kept = hits.join(able, "id")
    holders = kept.groupBy("key").agg(F.count(F.lit(1)).alias("holders")).filter("holders > 1")
    # linked documents share as many keys as either needs: all but one of those may go, and
    # the most frequent do, such as those of passages that many documents quote
    own = W.partitionBy("id").orderBy(F.desc("holders"), "key")
    rest = kept.join(holders, "key").withColumn("rank", F.row_number().over(own)).filter(
        F.col("rank") >= _need(F.col("n"), s)).select("id", "key")
    least = rest.groupBy("key").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("holders")).filter("holders > 1")
    near = rest.join(least.select("key", "least"), "key").filter("id <> least").select(
        F.col("id").alias("a"), F.col("least").alias("b")).distinct()
    grouped = components(near).select(F.col("node").alias("id"), F.col("component").alias("grp"))
    grouped = grouped.join(signatures.filter("size(keys) > 0").select("id", "n"), "id")
    tokens = grouped.groupBy("grp").agg(F.sum("n").alias("tokens_sum"))
    return stored(grouped.join(tokens, "grp")), classes


def _large_groups(sets: DataFrame, s: Shingling) -> DataFrame:
    """Links of groups that one task cannot hold.

    Such a group is dealt into chunks by size class and hash; sets of classes further apart
    than one cannot link. Each chunk is joined with itself, then with the first chunk of its
    class and of the class below. Sets that the largest component of their group does not
    hold by then are joined with every chunk of the classes around theirs. All other pairs
    are connected, so no link between components is lost, and copies of one text cost a few
    passes over their group.
    """
    widest = F.log(F.lit(100 / s.percent))
    classed = stored(
        sets.drop("tokens_sum").withColumn("size_class", F.floor(F.log(F.col("n").cast("double")) / widest)))
    dealt = classed.groupBy("grp", "size_class").agg(F.sum("n").alias("sum"))
    dealt = dealt.select("grp", "size_class", (F.floor(F.col("sum") / s.chunk_tokens) + 1).alias("chunks"))
    rows = classed.join(dealt, ["grp", "size_class"]).withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")))

    def tile(size_class: Column, chunk: Column, kind: str) -> Column:
        return F.concat_ws("/", F.lit(kind), F.col("grp").cast("string"), size_class.cast("string"), chunk.cast("string"))

    here, own = F.col("size_class"), F.col("chunk")
    inside = _join_tiles(rows.select(tile(here, own, "self").alias("tile"), "id", F.lit(0).alias("side"), F.col("id").alias("label"), "tokens"), s.percent)
    first = rows.filter("chunk = 0")
    around = dealt.select(F.col("grp").alias("g"), F.col("size_class").alias("c"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("k"))
    near = (F.col("grp") == F.col("g")) & F.col("size_class").isin(F.col("c"), F.col("c") - 1)
    star = first.join(around, near & ((F.col("k") > 0) | (F.col("size_class") != F.col("c"))))
    star_tiles = star.select(tile(F.col("c"), F.col("k"), "star").alias("tile"), "id", F.lit(0).alias("side"), F.col("id").alias("label"), "tokens").union(
        rows.select(tile(here, own, "star").alias("tile"), "id", F.lit(1).alias("side"), F.col("id").alias("label"), "tokens"))
    found = stored(inside.union(_two_sided(star_tiles, s.percent)))
    labels = components(found)
    known = stored(
        rows.join(labels, rows["id"] == labels["node"], "left")
        .withColumn("label", F.coalesce("component", "id")).drop("node", "component")
    )
    sizes = known.groupBy("grp", "label").agg(F.count(F.lit(1)).alias("held"))
    main = sizes.groupBy("grp").agg(F.max_by("label", F.struct("held", "label")).alias("main"))
    outside = known.join(main, "grp").filter("label <> main").drop("main")
    close = (F.col("grp") == F.col("g")) & (F.abs(F.col("size_class") - F.col("c")) <= 1)
    rest = outside.join(around, close).select(
        tile(F.col("c"), F.col("k"), "rest").alias("tile"), "id", F.lit(0).alias("side"), "label", "tokens"
    ).union(known.select(tile(here, own, "rest").alias("tile"), "id", F.lit(1).alias("side"), "label", "tokens"))
    return found.union(_two_sided(rest, s.percent))


def _two_sided(tiles: DataFrame, percent: int) -> DataFrame:
    """Tiles that hold both sides; a side alone has nothing to be joined with."""
    used = tiles.filter("side = 0").select("tile").distinct()
    return _join_tiles(tiles.join(used, "tile", "left_semi"), percent)


def linked_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     shingling: Shingling = Shingling()) -> DataFrame:
    """One row per document: the size of its shingle set and its component's smallest id.

    A document's set holds its distinct runs of ``words`` words, lower-cased in A-Z. Two
    documents link at ``percent`` of the union of their sets.

    Shingles are put in one order for all documents: those of rare words first, then by hash.
    Linked documents share shingles among the first of both sets, whatever the order, and more
    than one if each takes a few more; a document that shares fewer with any others has no
    link. Rare words make it unlikely that unlike documents meet. What is left forms candidate groups, most of a few documents, and a
    signature tree joins each group with itself, exactly. Equal sets count once: each task
    sends the keys of equal sets only once, so a text with copies in a third of all rows is
    a few rows per key.

    Defined results: words are ``[^\\x20\\x09-\\x0D]+``; a text of fewer words is one shingle;
    null, empty and blank texts have no set and link with nothing, so they are their own
    component. Rows with a null id link with nothing and have a null component. Rows that
    share an id are one document for links; each keeps its own set size. Other columns are
    ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("body"))
    signatures = stored(rows.mapInArrow(
        _signatures(shingling, _word_levels(rows)), "id long, n long, code_a long, code_b long, keys array<long>"))
    groups, classes = _candidates(signatures, shingling)
    small = groups.filter(F.col("tokens_sum") <= shingling.chunk_tokens)
    large = groups.filter(F.col("tokens_sum") > shingling.chunk_tokens)
    tiles = _whole_sets(rows, small, shingling).select(F.col("grp").alias("tile"), "id", F.lit(0).alias("side"), F.col("id").alias("label"), "tokens")
    links = _join_tiles(tiles, shingling.percent)
    if not large.isEmpty():
        links = links.union(_large_groups(_whole_sets(rows, large, shingling), shingling))
    label = components(links)
    tied = classes.join(label, classes["rep"] == label["node"], "left").withColumn("tie", F.coalesce("component", "rep"))
    smallest = tied.groupBy("tie").agg(F.min("least").alias("component_id"))
    named = tied.select("code_a", "code_b", "n", "tie").join(smallest, "tie").drop("tie")
    keys = ["code_a", "code_b", "n"]
    return (
        signatures.select("id", *keys).join(named, keys, "left")
        .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                F.when(F.col("id").isNull(), None).otherwise(F.coalesce("component_id", "id")).alias("component_id"))
    )
