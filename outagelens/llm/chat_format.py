"""Conversations as training text: turns sorted, merged by role and joined, and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

START, NEXT, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
LEARNED = "assistant"
#: turns of one part; a longer conversation is formatted in several parts
PART_TURNS = 256


def escape(text: Column) -> Column:
    """``<|`` never occurs in the result: of every ``<``, backslashes, ``|`` one backslash more."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    """A role on one line: backslashes doubled, line feeds and ``|`` written with one."""
    return F.replace(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit("|"), F.lit("\\|"))


def _unescape_role(role: Column) -> Column:
    pieces = F.split(role, r"\\\\", -1)
    plain = F.transform(pieces, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\|"), F.lit("|")))
    return F.array_join(plain, "\\")


def _merged(turns: Column) -> Column:
    """Blocks of adjacent turns with one role: array of (role, texts)."""
    def add(blocks: Column, turn: Column) -> Column:
        last = F.get(blocks, F.size(blocks) - 1)
        alone = F.array(F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts")))
        longer = F.array(F.struct(turn["role"].alias("role"), F.concat(last["texts"], F.array(turn["text"])).alias("texts")))
        return F.when((F.size(blocks) > 0) & (last["role"] == turn["role"]),
                      F.concat(F.slice(blocks, F.lit(1), F.size(blocks) - 1), longer)).otherwise(F.concat(blocks, alone))

    return F.aggregate(turns, F.expr("cast(array() as array<struct<role: string, texts: array<string>>>)"), add)


def _pieces(blocks: Column) -> Column:
    """What each turn adds to the text: (mark, body, learned), bodies escaped."""
    def of_block(block: Column, k: Column) -> Column:
        close = F.when(k > 0, F.lit(f"{END}\n")).otherwise(F.lit(""))
        opening = F.concat(close, F.lit(START), _escape_role(block["role"]), F.lit("\n"))
        return F.transform(block["texts"], lambda text, j: F.struct(
            F.when(j == 0, opening).otherwise(F.lit(NEXT)).alias("mark"), escape(text).alias("body"),
            (block["role"] == LEARNED).alias("learned")))

    return F.flatten(F.transform(blocks, of_block))


def _loss(pieces: Column) -> Column:
    """Code point spans of the bodies that are learned."""
    def add(acc: Column, piece: Column) -> Column:
        start = acc["at"] + F.char_length(piece["mark"])
        end = start + F.char_length(piece["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(piece["learned"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    zero = F.expr("named_struct('at', 0, 'spans', cast(array() as array<struct<start: int, end: int>>))")
    return F.aggregate(pieces, zero, add, lambda acc: acc["spans"])


def formatted(convs: DataFrame, conv_col: str = "conv_id", part_turns: int = PART_TURNS) -> DataFrame:
    """Training text of every conversation: conv_col, part, formatted, loss_spans.

    Turns stand by turn; adjacent ones of one role share a block, ``<|im_start|>role``, their
    texts with ``<|im_sep|>`` between, ``<|im_end|>``. Marks inside texts are escaped, so that
    ``read_back`` gives every turn as it was. ``loss_spans`` (code points, end exclusive) cover
    each assistant text, and no mark.

    Rows move once, by conversation; a sort that can spill numbers them, and every
    ``part_turns`` turns make a part, so that no more are collected at once, however long a
    conversation is. All but the longest have one part, 0.

    Defined results: null roles and texts are empty; null turns come first; rows of one turn go
    by role and text, and repeated rows are all kept. Rows without conversation id form one
    conversation with a null id. Other columns are ignored; an empty table gives none.
    """
    rows = convs.select(
        F.col(conv_col).alias("conv"), F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    number = F.row_number().over(W.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    numbered = rows.withColumn("at", number - 1)
    parts = (
        numbered.groupBy("conv", F.floor(F.col("at") / part_turns).alias("part"))
        .agg(F.sort_array(F.collect_list(F.struct("at", "role", "text"))).alias("turns"))
        .withColumn("pieces", _pieces(_merged(F.col("turns"))))
    )
    text = F.concat(F.array_join(F.transform("pieces", lambda p: F.concat(p["mark"], p["body"])), ""), F.lit(f"{END}\n"))
    return parts.select(F.col("conv").alias(conv_col), "part", text.alias("formatted"), _loss(F.col("pieces")).alias("loss_spans"))


def _literal(mark: str) -> str:
    return mark.replace("|", "\\|")


def read_back(texts: DataFrame) -> DataFrame:
    """Adds to the rows of ``formatted``: turns, array of (role, text), and loss, array of texts.

    Both come from the text alone: turns by its marks, loss by its spans, unescaped.
    """
    def turns_of(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        begin = F.char_length(role) + 2
        body = F.substring(block, begin, F.char_length(block) - begin + 1 - len(END) - 1)
        return F.transform(F.split(body, _literal(NEXT), -1),
                           lambda t: F.struct(_unescape_role(role).alias("role"), unescape(t).alias("text")))

    blocks = F.split("formatted", _literal(START), -1)
    turns = F.flatten(F.transform(F.slice(blocks, F.lit(2), F.size(blocks)), turns_of))
    loss = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    return texts.withColumn("turns", turns).withColumn("loss", loss)
