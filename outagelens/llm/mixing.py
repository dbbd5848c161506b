"""Mixing sources to target weights in blocks of a fixed number of words."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outagelens.llm.shared import stored

WORD = r"[^\x20\x09-\x0D]+"
WORD_WITH_SPACE = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"
#: primes above any number of blocks: multiplying by one permutes the block numbers
_PRIMES = [2305843009213693951, 1741937612927958197, 1979648110353563801, 1727197832005276541]


@dataclass(frozen=True)
class Mix:
    """Weights repeat over the sources in code point order, the null source last."""

    weights: tuple[int, ...] = (5, 2, 1)
    most_repeats: int = 3
    block_words: int = 64
    shard_slots: int = 65_536
    rows_per_bucket: int = 4_096
    seed: int = 17


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per source: its size, target, blocks and the slots it fills in the mix.

    Targets share the total by weight; none exceeds ``most_repeats`` times its source. With
    sources ordered by size for weight, those before some point are full and the others get
    a common rate per weight. Windows here run over one row per source.
    """
    by_name, by_ratio = W.orderBy(F.col("source").asc_nulls_last()), W.orderBy("ratio", F.col("source").asc_nulls_last())
    before, rest, whole = by_ratio.rowsBetween(W.unboundedPreceding, -1), by_ratio.rowsBetween(0, W.unboundedFollowing), W.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in mix.weights]),
                          ((F.row_number().over(by_name) - 1) % len(mix.weights) + 1).cast("int"))
    limits = (
        sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * F.lit(float(mix.most_repeats)))
        .withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(whole))
        .withColumn("rate", (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
                    / F.sum("weight").over(rest))
    )
    rate = F.max(F.when(F.col("rate") * F.col("weight") <= F.col("most"), F.col("rate"))).over(whole)
    blocks = F.ceil(F.col("source_size") / mix.block_words)
    wanted = F.round(F.try_divide(F.col("target") * F.col("blocks"), F.col("source_size"))).cast("long")
    return (
        limits.withColumn("target", F.least(F.col("most"), F.coalesce(rate, F.lit(0.0)) * F.col("weight")))
        .withColumn("blocks", blocks)
        .withColumn("slots", F.coalesce(F.least(wanted, F.col("blocks") * mix.most_repeats), F.lit(0)))
        .select("source", "source_size", "target", "blocks", "slots")
    )


def placed(sized: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Adds ``start``: the words of the same source that come before the row.

    Rows fall into buckets of bounded size by hash; sums of buckets give each bucket's
    offset, and a window inside the bucket the rest. So no task sees a whole source.
    """
    buckets = sized.select(F.greatest(F.ceil(F.count(F.lit(1)) / mix.rows_per_bucket), F.lit(1))).scalar()
    dealt = sized.withColumn("bucket", F.pmod(F.xxhash64("id", "version"), buckets))
    earlier = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = (
        dealt.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
        .select(F.col("source").alias("s"), F.col("bucket").alias("b"),
                F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    )
    inside = W.partitionBy("source", "bucket").orderBy("id", "version").rowsBetween(W.unboundedPreceding, -1)
    return (
        dealt.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
        .withColumn("start", F.col("offset") + F.col("inner"))
        .drop("s", "b", "offset", "inner", "bucket")
    )


def shard_plan(targets: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(source, blocks, shard, first, count): how many slots of a source each shard holds.

    Every slot of the mix draws its output shard, so a shard's counts of the sources are
    multinomial; a source has as many slots as its target asks for, so what the last draws
    get makes up for the others and the whole mix meets the targets. ``first`` counts the
    source's slots in the shards before. A row per source and shard.
    """
    shards = F.greatest(F.ceil(F.sum("slots").over(W.partitionBy()) / mix.shard_slots), F.lit(1))
    step = 4_096
    name = F.coalesce("source", F.lit("null"))
    drawn = (
        targets.withColumn("shards", shards).filter("slots > 0")
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.floor((F.col("slots") - 1) / step))))
        .repartition(F.col("source"), F.col("part"))
        .withColumn("slot", F.explode(F.sequence(
            F.col("part") * step, F.least((F.col("part") + 1) * step, F.col("slots")) - 1)))
        .withColumn("shard", F.pmod(F.xxhash64(F.lit(mix.seed + 2), name, F.col("slot")), F.col("shards")))
    )
    counts = drawn.groupBy("source", "blocks", "shard").agg(F.count(F.lit(1)).alias("count"))
    earlier = W.partitionBy("source").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    return counts.withColumn("first", F.coalesce(F.sum("count").over(earlier), F.lit(0)))


def slots(targets: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(source, slot, shard, block): which block of its source each slot of the mix holds.

    The counts drawn for a shard say which of a source's slots are its own. They run through
    the source's blocks by a permutation of block numbers, another one each time round.
    """
    step = 4_096
    spread = (
        shard_plan(targets, mix)
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.floor((F.col("count") - 1) / step))))
        .repartition(F.col("source"), F.col("shard"), F.col("part"))
        .withColumn("slot", F.explode(F.sequence(
            F.col("first") + F.col("part") * step, F.col("first") + F.least((F.col("part") + 1) * step, F.col("count")) - 1)))
    )
    turn = F.floor(F.col("slot") / F.col("blocks"))
    name = F.coalesce("source", F.lit("null"))
    prime = F.element_at(F.array(*[F.lit(p) for p in _PRIMES]),
                         F.pmod(F.xxhash64(F.lit(mix.seed), name, turn), F.lit(len(_PRIMES))).cast("int") + 1)
    wide = "decimal(19,0)"
    block = ((F.col("slot") % F.col("blocks")).cast(wide) * (prime % F.col("blocks")).cast(wide)
             + F.pmod(F.xxhash64(F.lit(mix.seed + 1), name, turn), F.col("blocks"))) % F.col("blocks").cast(wide)
    return spread.select("source", "slot", "shard", block.cast("long").alias("block"))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Words per document, counted once and kept: four numbers a row."""
    return stored(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"),
        F.xxhash64(text_col).alias("version"),
    ))


def _taken_pieces(rows: DataFrame, targets: DataFrame, mix: Mix, by: tuple[str, ...] = ()) -> DataFrame:
    """(source, start, first, words, copies): pieces of documents that the mix takes; with
    ``by`` ("shard",) those of each shard."""
    copies = slots(targets, mix).groupBy("source", "block", *by).agg(F.count(F.lit(1)).alias("copies"))
    copies = copies.select(F.col("source").alias("s"), F.col("block").alias("b"), *by, "copies")
    end = F.col("start") + F.col("size")
    size = F.lit(mix.block_words)
    pieces = (
        rows.filter("size > 0")
        .select("source", "start", "size", F.explode(F.sequence(
            F.floor(F.col("start") / size), F.floor((end - 1) / size))).alias("block"))
        .withColumn("low", F.greatest(F.col("block") * size, F.col("start")))
        .withColumn("words", F.least((F.col("block") + 1) * size, end) - F.col("low"))
    )
    # the blocks come from a few rows by explode, so their estimated size is far too small
    return pieces.join(copies.hint("merge"), F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))).select(
        "source", "start", *by, (F.col("low") - F.col("start")).alias("first"), "words", "copies")


def shard_counts(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text",
                 source_col: str = "source") -> DataFrame:
    """(shard, source, slots): the blocks of each source that were drawn for each output shard."""
    targets = source_targets(_sized(docs, id_col, text_col, source_col), mix)
    return shard_plan(targets, mix).select("shard", "source", F.col("count").alias("slots"))


def mix_sizes(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text",
              source_col: str = "source") -> DataFrame:
    """One row per document: its words, its source's words and target, the words taken.

    Each source's words stand in one line, cut into blocks of ``block_words``; the mix takes
    whole blocks by number, none more than ``most_repeats`` times, so no document is taken
    more often than that. Reruns give the same rows.

    Defined results: a null or empty text has no words and nothing taken; the null source is
    a source of its own, last in order; documents without any words give targets of 0. Rows
    that repeat id and text count each. Other columns are ignored.
    """
    sized = _sized(docs, id_col, text_col, source_col)
    targets = source_targets(sized, mix)
    rows = placed(sized, mix)
    taken = (
        _taken_pieces(rows, targets, mix).groupBy("source", "start")
        .agg(F.sum(F.col("words") * F.col("copies")).alias("taken"))
        .select(F.col("source").alias("s"), F.col("start").alias("p"), "taken")
    )
    mine = (F.col("source").eqNullSafe(F.col("s"))) & (F.col("start") == F.col("p")) & (F.col("size") > 0)
    about = targets.select(F.col("source").alias("t"), "source_size", "target")
    return (
        rows.join(taken, mine, "left")
        .join(about, F.col("source").eqNullSafe(F.col("t")))
        .select(F.col("id").alias(id_col), "size", "source_size", "target",
                F.coalesce("taken", F.lit(0)).alias("taken"))
    )


def mixed_documents(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", shard_col: str | None = None) -> DataFrame:
    """The documents of the mix: each with the words taken from it, repeats after a newline.

    Spaces before a word stay with it. Documents of which nothing is taken go. All other
    columns stay as they are. With ``shard_col`` a document has one row for each output shard
    that takes words of it, and a column of that name; all rows of a shard are that shard's
    mix. Defined results as for ``mix_sizes``.
    """
    by = ("shard",) if shard_col else ()
    sized = _sized(docs, id_col, text_col, source_col)
    numbered = W.partitionBy("id", "version", "source").orderBy("start")
    rows = placed(sized, mix)
    pieces = (
        _taken_pieces(rows, source_targets(sized, mix), mix, by).groupBy("source", "start", *by)
        .agg(F.sort_array(F.collect_list(F.struct("first", "words", "copies"))).alias("pieces"))
        .select(F.col("source").alias("s"), F.col("start").alias("p"), *by, "pieces")
    )
    chosen = (
        rows.withColumn("copy", F.row_number().over(numbered))
        .join(pieces, F.col("source").eqNullSafe(F.col("s")) & (F.col("start") == F.col("p")) & (F.col("size") > 0))
        .select(F.col("id").alias("i"), F.col("version").alias("v"), F.col("source").alias("o"), F.col("copy").alias("c"), *by, "pieces")
    )
    own = W.partitionBy("id", "version", "source").orderBy(F.lit(1))
    texts = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("version"), F.col(source_col).alias("source"),
    ).withColumn("copy", F.row_number().over(own))
    joined = texts.join(chosen, F.col("id").eqNullSafe(F.col("i")) & (F.col("version") == F.col("v"))
                        & F.col("source").eqNullSafe(F.col("o")) & (F.col("copy") == F.col("c")))
    found = F.regexp_extract_all(F.col("row")[text_col], F.lit(WORD_WITH_SPACE), F.lit(0))

    def again(all_words: Column, turn: Column) -> Column:
        mine = F.filter("pieces", lambda p: p["copies"] >= turn)
        parts = F.transform(mine, lambda p: F.slice(all_words, (p["first"] + 1).cast("int"), p["words"].cast("int")))
        return F.array_join(F.flatten(parts), "")

    most = F.array_max(F.transform("pieces", lambda p: p["copies"]))
    # binding the words to a lambda variable finds them once, not once a piece
    text = F.transform(F.array(found), lambda all_words: F.array_join(
        F.transform(F.sequence(F.lit(1).cast("long"), most), lambda turn: again(all_words, turn)), "\n"))[0]
    return joined.select(*[text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns],
                         *[F.col(c).alias(shard_col) for c in by])
