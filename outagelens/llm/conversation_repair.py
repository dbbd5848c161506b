"""Conversations brought to the order of a chat by the cheapest edits.

Every conversation is a word over few symbols, one for each row's role and fault. The cost of
the rest of a word depends on that rest and on the state of the grammar only, so words are
read from their ends: those that end alike share the nodes of one automaton.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outagelens.llm import text_arrays

#: costs of an edit and of a truncated row that stays
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: states of ``(s?(ua)+)?``: nothing yet, after s, after a whole pair, after u
EMPTY, SYSTEM, PAIR, USER = range(4)
#: by state: the role that edits can bring, the state it leads to, and the role's name
WANTED = {EMPTY: ("u", USER), SYSTEM: ("u", USER), PAIR: ("u", USER), USER: ("a", PAIR)}
NAMES = {"u": "user", "a": "assistant"}
#: six separators and no other character
SPACES = " \t\n\x0b\x0c\r"
GONE, STRANGE = "d", "x"
PLAN = "array<struct<place: int, role: string>>"
#: least cost from here to the end; by state: cost beyond it, and the first edit
Node = tuple[int, tuple[int, ...], tuple[str, ...]]


def damaged(convs: DataFrame) -> DataFrame:
    """Rows with the faults that tests plant: conv_id, turn, role, text.

    By CRC-32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 removes its
    ``.!?``, 3 repeats it, 4 sets role user. Null ids and turns are one space in that text, and
    null roles and texts are one space in the rows.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(key) % 20
    role, text = F.coalesce(F.col("role").cast("string"), blank), F.coalesce(F.col("text").cast("string"), blank)
    changed = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    rows = convs.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"), changed.alias("text"), kind.alias("_kind"))
    copies = F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.filter("_kind <> 0").withColumn("_copy", copies).drop("_kind", "_copy")


def _with_inserts(best: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """An insert changes the state and not the row; a few rounds settle all four states."""
    for _ in range(4):
        best = [min(best[s], (INSERT + best[WANTED[s][1]][0], "I")) for s in range(4)]
    return best


def _node(best: list[tuple[int, str]]) -> Node:
    low = min(c for c, _ in best)
    return low, tuple(c - low for c, _ in best), tuple(e for _, e in best)


#: after the last row: nothing and whole pairs may end, the other states have to insert
_NO_END = 1 << 40
_END = _node(_with_inserts([(0, ""), (_NO_END, ""), (0, ""), (_NO_END, "")]))


@lru_cache(maxsize=65_536)
def _before(symbol: str, costs: tuple[int, ...]) -> Node:
    """The node of a row, from the costs behind it.

    Costs are relative to their least, so few differ: nodes with equal futures are one.
    """
    late = TRUNCATED if symbol.isupper() else 0
    best = []
    for state, (wanted, after) in WANTED.items():
        options = [(DELETE + costs[state], "D")]
        if symbol != GONE:
            options.append((REROLE + late + costs[after], "R"))
            if symbol.lower() == wanted:
                options.append((late + costs[after], "K"))
            elif symbol.lower() == "s" and state == EMPTY:
                options.append((late + costs[SYSTEM], "K"))
        best.append(min(options))
    return _node(_with_inserts(best))


def _plan(word: str, nodes: list[Node]) -> tuple[str, list[tuple[int, str | None]]]:
    """The edits along one path and the messages they leave: (row or -1, new role or null)."""
    audit, messages, state, place = [], [], EMPTY, 0
    while edit := nodes[len(word) - place][2][state]:
        audit.append(edit)
        if edit == "K":
            messages.append((place, None))
            state = SYSTEM if word[place].lower() == "s" else WANTED[state][1]
        elif edit != "D":
            role, state = WANTED[state]
            messages.append((-1 if edit == "I" else place, NAMES[role]))
        place += edit != "I"
    return "".join(audit), messages


def _automaton(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, cost, audit, plan) of words that come sorted by their reverse.

    A word shares with the one before it the nodes of their common end; only the nodes of the
    present path are held.
    """
    path, totals, before = [_END], [_END[0]], ""
    for batch in text_arrays.slices(batches):
        words, costs, audits, plans = batch.column("word").to_pylist(), [], [], []
        for word in words:
            turned = word[::-1]
            shared = len(os.path.commonprefix([turned, before]))
            del path[shared + 1 :], totals[shared + 1 :]
            for symbol in turned[shared:]:
                path.append(_before(symbol, path[-1][1]))
                totals.append(totals[-1] + path[-1][0])
            before = turned
            audit, plan = _plan(word, path)
            costs.append(totals[-1] + path[-1][1][EMPTY])
            audits.append(audit)
            plans.append([{"place": p, "role": r} for p, r in plan])
        kind = pa.list_(pa.struct([("place", pa.int32()), ("role", pa.string())]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array(costs, pa.int64()), pa.array(audits, pa.string()), pa.array(plans, kind)],
            names=["word", "cost", "audit", "plan"])


def cheapest_edits(words: DataFrame) -> DataFrame:
    """(word, cost, audit, plan) of every distinct ``word``, a string of row symbols.

    Symbols: ``u a s`` the role's initial, ``x`` any other, upper case if the row is truncated,
    ``d`` a row that has to go. Distinct words are dealt by ranges of their reverse, so words
    that end alike meet in one task and each node is made once; ranges are even, as no word
    comes twice.
    """
    turned = F.reverse("word")
    return (
        words.select("word").distinct().withColumn("turned", turned)
        .repartitionByRange("turned").sortWithinPartitions("turned").select("word")
        .mapInArrow(_automaton, f"word string, cost long, audit string, plan {PLAN}")
    )


def with_faults(convs: DataFrame) -> DataFrame:
    """Rows with their place in the conversation, first fault, symbol and what adjacency tells.

    Adds at (from 1), fault (blank, duplicate, truncated or null), symbol, illegal, new_turn.
    """
    rows = convs.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    in_order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    same = W.partitionBy("conv_id", "role", "text").orderBy("at")
    first_of = F.when(F.col("role") == "", "?").otherwise(F.substring("role", 1, 1))
    trimmed = F.rtrim("text", F.lit(SPACES))
    numbered = (
        rows.withColumn("initial", first_of)
        .withColumn("at", F.row_number().over(in_order))
        .withColumn("pair", F.concat(F.lag("initial").over(in_order), F.col("initial")))
        .withColumn("new_turn", F.col("turn").isNotNull() & ~F.coalesce(F.lag("turn").over(in_order) == F.col("turn"), F.lit(False)))
        .withColumn("nth", F.row_number().over(same))
    )
    fault = (
        F.when(trimmed == "", "blank").when(F.col("nth") > 1, "duplicate")
        .when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), "truncated")
    )
    initial = F.when(F.col("initial").isin("u", "a", "s"), F.col("initial")).otherwise(STRANGE)
    symbol = (
        F.when(F.col("fault").isin("blank", "duplicate"), GONE)
        .when(F.col("fault") == "truncated", F.upper(initial)).otherwise(initial)
    )
    return numbered.withColumn("fault", fault).select(
        "conv_id", "at", "turn", "role", "text", "fault", symbol.alias("symbol"),
        (~F.coalesce(F.col("pair").isin("su", "ua", "au"), F.lit(True))).alias("illegal"), "new_turn")


def _count(flag: Column) -> Column:
    return F.sum(F.when(flag, 1).otherwise(0)).cast("long")


def repaired(convs: DataFrame) -> DataFrame:
    """One row per conversation: its faults, the cheapest edits and the messages they leave.

    Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and messages, an
    array of (role, text) whose role initials form ``(s?(ua)+)?``. Keeping costs 0, a new role
    3, deletion 4 (blank rows and duplicates have to go), an inserted empty message 3; a
    truncated row that stays adds 3. Of equal costs the least audit in ASCII stays.

    Rows move once, by conversation, and are numbered and compared in sorts that can spill;
    the automaton sees one symbol a row, and each distinct word once. A conversation's messages
    are one row of the result, so its text has to fit into a row.

    Defined results: null roles and texts are one space, a role without text has the initial
    ``?``. Null turns come first and don't count in gaps; gaps beyond 64 bits are null. Rows of
    one turn go by role and text; of repeated rows the first is none. Rows without a conversation
    id form one conversation. Other columns are ignored; an empty table gives none.
    """
    rows = with_faults(convs)
    turns = F.col("turn").cast("decimal(38,0)")
    per_conv = rows.groupBy("conv_id").agg(
        (F.max(turns) - F.min(turns) + 1 - _count(F.col("new_turn"))).alias("gaps"),
        *[_count(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
        _count(F.col("illegal")).alias("illegal"),
        F.sort_array(F.collect_list(F.struct("at", "symbol", "role", "text"))).alias("rows"),
    ).withColumn("word", F.array_join("rows.symbol", ""))
    message = lambda p: F.struct(
        F.coalesce(p["role"], F.get("rows", p["place"])["role"]).alias("role"),
        F.coalesce(F.get("rows", p["place"])["text"], F.lit("")).alias("text"))
    return per_conv.join(cheapest_edits(per_conv), "word").select(
        "conv_id", F.coalesce(F.expr("try_cast(gaps as long)"), F.when(F.col("gaps").isNull(), F.lit(0))).alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.transform("plan", message).alias("messages"))
