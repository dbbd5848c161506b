"""One row per key over all years, although the years are loaded in separate calls.

Beside the table stands an index: for each year the 64-bit hashes of the keys that it
delivered, kept or not. A load looks its own keys up there, finds the years that know any of
them, and rewrites these only. A key that its newest file no longer holds is looked up too, so
the row of another year that it had displaced comes back.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outagelens.operators.dedupe import latest_of_listed, latest_per_key
from outagelens.session import shuffles_dropped
from outagelens.sources import tables

HASH, TIMES, ALL = "_chave", "_vezes", "_todas"
OPEN, CLOSED = "ABERTA", "FECHADA"
_STATE = """estado STRING, carregados ARRAY<INT>, reescritos ARRAY<INT>, esquema STRING,
    linhas MAP<INT, BIGINT>, chaves MAP<INT, BIGINT>"""
#: keys that one load may list for every executor, at 8 bytes each; of more, a bitmap of at most
#: ``BITS`` for each key that could have been listed tells most rows of other keys
LISTED_KEYS, BITS = 1_000_000, 256


def _if_there(read: Callable[[], DataFrame]) -> DataFrame | None:
    try:
        return read()
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return None


def _keys(spark: SparkSession, path: str, year_col: str) -> DataFrame:
    return spark.read.schema(f"{HASH} BIGINT, {year_col} INT").parquet(path)


def _replace(spark: SparkSession, path: str, schema: T.StructType, year_col: str, years: list[int], loaded: list[int],
             moved: bool = True) -> None:
    """Staged years to the table, then to the index; what is staged without ``moved`` stays and is written again."""
    staged, keys = spark.read.schema(schema).parquet(f"{path}_nova"), _keys(spark, f"{path}_chaves_nova", year_col)
    tables.replace_years_measured(staged, path, year_col, years, None, None, True, *[f"{path}_nova"] * moved)
    tables.replace_years_measured(keys, f"{path}_chaves", year_col, loaded, None, None, True, *[f"{path}_chaves_nova"] * moved)


def _mark(spark: SparkSession, path: str, *state) -> None:
    """state, years loaded, years rewritten, schema, and the rows and keys staged per year"""
    spark.createDataFrame([state], _STATE).coalesce(1).write.mode("overwrite").parquet(f"{path}_troca")


def _still_staged(spark: SparkSession, staged: str, year_col: str, rows: dict[int, int]) -> list[int]:
    """Years whose staged folder is whole. Where a store moves a folder by copy and removal, one
    that lost files has been copied whole before."""
    found = spark.read.schema(f"{year_col} INT").parquet(staged).groupBy(year_col).count().collect()
    there = {r[0]: r["count"] for r in found}
    return [y for y, n in rows.items() if there.get(y, 0) == n]


def finish(spark: SparkSession, path: str, year_col: str, sort: list[str] | None = None) -> list[int]:
    """Complete a replacement that a crash cut short; returns the years it replaced.

    Years leave the staged folders one by one as they replace the table's, so those that are
    still there are the ones to replace. ``sort`` is not needed: rows are staged sorted.
    """
    state = _if_there(lambda: spark.read.schema(_STATE).parquet(f"{path}_troca"))
    row = state.first() if state is not None else None
    if row is None or row["estado"] != OPEN:
        return []
    schema, loaded, years = T.StructType.fromJson(json.loads(row["esquema"])), row["carregados"], [*row["carregados"], *row["reescritos"]]
    if row["linhas"] is None:  # staged before years were moved: without folders for years that became empty
        _replace(spark, path, schema, year_col, years, loaded, moved=False)
    else:
        _replace(spark, path, schema, year_col, _still_staged(spark, f"{path}_nova", year_col, row["linhas"]),
                 _still_staged(spark, f"{path}_chaves_nova", year_col, row["chaves"]))
    _mark(spark, path, CLOSED, *row[1:])
    return years


def _sieve(keys: DataFrame, number: int) -> Callable[[DataFrame, str], DataFrame] | None:
    """Parts rows where they are, by hashes: ``left_semi`` keeps rows of these keys, ``left_anti`` all others.

    A short list parts them exactly. Of a longer one each executor gets a bitmap: rows of some
    16th of the other hashes, at 16 bits a key, then go with those of the keys, while a row
    of a listed key never goes with the others. None if the bitmap would be too dense to help.
    """
    if number <= LISTED_KEYS:
        return lambda rows, how: rows.join(F.broadcast(keys.select(HASH)), HASH, how)
    bits = 1 << min((16 * number).bit_length(), (BITS * LISTED_KEYS).bit_length() - 1) if LISTED_KEYS else 0
    if bits < 4 * number:
        return None
    place = F.col(HASH).bitwiseAND(F.lit(bits - 1))
    row, word, bit = F.shiftright(place, 12), F.shiftright(place, 6).bitwiseAND(F.lit(63)), place.bitwiseAND(F.lit(63)).cast("int")
    words = keys.select(row.alias("_linha"), word.cast("int").alias("_palavra"), bit.alias("_bit")).groupBy("_linha", "_palavra").agg(
        F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))
    by_word = F.map_from_entries(F.collect_list(F.struct("_palavra", "_bits")))
    bitmap = words.groupBy("_linha").agg(by_word.alias("_por_palavra")).select("_linha", F.transform(
        F.sequence(F.lit(0), F.lit(63)), lambda w: F.coalesce(F.try_element_at("_por_palavra", w), F.lit(0).cast("bigint"))).alias("_mapa"))
    hit = (F.col("_linha") == row) & (F.getbit(F.get("_mapa", word.cast("int")), bit) == 1)
    return lambda rows, how: rows.join(F.broadcast(bitmap), hit, how)


def merge_years(
    spark: SparkSession,
    delivered: Callable[[list[int]], DataFrame],
    path: str,
    years: list[int],
    keys: list[str],
    order: list[str],
    year_col: str,
    stamps: dict[str, Column] | None = None,
    sort: list[str] | None = None,
    totals: dict[str, Column] | None = None,
) -> dict[int, dict[str, int]]:
    """Load ``years`` into the table at ``path``; returns what was written per year.

    ``delivered`` gives the conformed rows that some years' files hold now; the newest row of
    a key over all years loaded so far stays, in the partition of its own year, whichever
    call loaded it. Years named in the result beside ``years`` shared a key with them; all
    others keep their files. ``stamps`` are set on rows that this load decided; ``totals`` are
    summed beside the rows.

    Only hashes are compared: the index is 8 bytes a key and year. Disputed are the hashes that
    several delivered rows hold, or that other years know too. While they hold at most half of
    the rows and a list or bitmap of them fits every task, only their rows are dealt by key and sorted,
    and all others go from their scan to the write; otherwise all delivered rows are. Of other
    years, deliveries are read for the hashes they share with this load, and stored rows for all
    others. A hash that two keys share only brings both of them into the comparison, by their
    whole keys.

    What is to change is staged whole before any of it is replaced, so a crash leaves either
    the table as it was or a replacement that the next call completes first. Each row is
    written once: staged years are then moved into the table.
    """
    finish(spark, path, year_col, sort)
    digest = F.xxhash64(*keys)
    fresh = delivered(years).withColumn(HASH, digest)
    # the new keys are found once and staged; all comparisons read them from there
    by_year = fresh.groupBy(HASH).agg(*[F.count_if(F.col(year_col) == y).alias(f"{TIMES}_{y}") for y in dict.fromkeys(years)])
    times = {y: F.col(f"{TIMES}_{y}") for y in dict.fromkeys(years)}
    held = F.filter(F.array(*[F.struct(F.lit(y).cast("int").alias(year_col), n.alias(TIMES)) for y, n in times.items()]), lambda of: of[TIMES] > 0)
    delivered_keys = by_year.select(HASH, sum(times.values(), F.lit(0).cast("bigint")).alias(ALL), F.inline(held))
    keys_staged = tables.stage_years(delivered_keys, f"{path}_chaves_nova", year_col, years, None, {"vezes": F.col(TIMES)}, True)
    new_keys = spark.read.schema(f"{HASH} BIGINT, {ALL} BIGINT, {year_col} INT").parquet(f"{path}_chaves_nova")

    index = _if_there(lambda: _keys(spark, f"{path}_chaves", year_col))
    stored = _if_there(lambda: spark.read.parquet(path))
    if index is None and stored is not None:  # a table from before there was an index
        older = [r[0] for r in stored.select(year_col).distinct().collect() if r[0] is not None]
        if older:
            seen = delivered(older).select(digest.alias(HASH), F.col(year_col).cast("int").alias(year_col)).distinct()
            tables.replace_years(seen, f"{path}_chaves", year_col, older)
            index = _keys(spark, f"{path}_chaves", year_col)

    several = new_keys.filter(F.col(ALL) > 1).groupBy(HASH).agg(F.max(ALL).alias(TIMES))
    disputes = several.select(HASH, TIMES, F.lit(None).cast("int").alias("_ano"))
    if index is not None:
        mine = F.col(year_col).isin(years)
        touched = new_keys.select(HASH).union(index.filter(mine).select(HASH))
        known = index.filter(~mine).join(touched, HASH, "left_semi")
        disputes = disputes.union(known.select(HASH, F.lit(0).cast("bigint"), year_col))
    with shuffles_dropped(spark):
        disputes.write.mode("overwrite").parquet(f"{path}_disputadas")
    disputes = spark.read.schema(disputes.schema).parquet(f"{path}_disputadas")
    found = disputes.agg(F.count(F.lit(1)), F.sum(TIMES), F.collect_set("_ano"), F.count("_ano")).first()
    concerned = sorted(found[2])
    delivered_rows = sum(of["vezes"] for of in keys_staged.values())
    shared = disputes.filter(F.col("_ano").isNotNull()).select(HASH)
    # counted above, so every task can hold what parts the rows, and scanned rows stay where they are
    part, part_shared = _sieve(disputes, found[0]), _sieve(shared, found[3])
    apart = part is not None and 2 * (found[1] or 0) <= delivered_rows

    rivals = part(fresh, "left_semi") if apart else fresh
    if concerned:
        again = delivered(concerned).withColumn(HASH, digest)
        again = part_shared(again, "left_semi") if part_shared else again
        if found[3] > LISTED_KEYS:  # some rows of other keys are left
            again = latest_of_listed(again, [HASH, *keys], order, shared, HASH)
        rivals = rivals.unionByName(again.select(*rivals.columns))
    # the hash first: rows are sorted by a number and not by texts that mostly begin alike
    merged = latest_per_key(rivals, [HASH, *keys], order).drop(HASH).withColumns(stamps or {})
    in_place = [part(fresh, "left_anti").drop(HASH).withColumns(stamps or {})] if apart else []
    if concerned:
        rest = stored.filter(F.col(year_col).isin(concerned)).withColumn(HASH, digest)
        if part_shared:
            in_place.append(part_shared(rest, "left_anti").select(*merged.columns))
        if found[3] > LISTED_KEYS:
            rest = part_shared(rest, "left_semi") if part_shared else rest
            merged = merged.unionByName(rest.join(shared, HASH, "left_anti").select(*merged.columns))
    merged = merged.hint("rebalance", F.col(year_col))
    for rows in in_place:
        merged = merged.unionByName(rows)

    written = tables.stage_years(merged, f"{path}_nova", year_col, [*years, *concerned], sort, totals, True)
    state = (years, concerned, merged.schema.json(), {y: of["linhas"] for y, of in written.items()},
             {y: of["linhas"] for y, of in keys_staged.items()})
    _mark(spark, path, OPEN, *state)
    _replace(spark, path, merged.schema, year_col, [*years, *concerned], years)
    _mark(spark, path, CLOSED, *state)
    return written
