"""Ranges of missing months, limits in force, robust jumps, cause tree, null counts."""

import datetime as dt
from statistics import median

import pytest
from pyspark.sql import functions as F

from outagelens.operators import compare, filters, indicators, outages, profiling, sketches

DAY = dt.date


def ranges(frame, **bounds):
    rows = outages.missing_ranges(frame, ["s"], "y", "m", **bounds).collect()
    return sorted((r["s"], r["primeiro_mes"].isoformat()[:7], r["ultimo_mes"].isoformat()[:7], r["meses"]) for r in rows)


def test_missing_ranges(spark):
    have = {
        "a": [(2023, 11), (2024, 2), (2024, 2), (2024, 3), (2024, 6)],
        "b": [(2023, 11), (2023, 12), (2024, 1), (2024, 2), (2024, 3), (2024, 4), (2024, 5), (2024, 6)],
        "c": [(None, 3), (2024, 13), (2024, None)],
        "d": [(2024, 1), (None, None)],
    }
    frame = spark.createDataFrame([(s, *d) for s, own in have.items() for d in own], "s string, y int, m int")
    assert ranges(frame) == [
        ("a", "2023-12", "2024-01", 2), ("a", "2024-04", "2024-05", 2), ("c", "2023-11", "2024-06", 8),
        ("d", "2023-11", "2023-12", 2), ("d", "2024-02", "2024-06", 5)]
    assert ranges(frame, first=DAY(2024, 2, 1), last=DAY(2024, 4, 1)) == [
        ("a", "2024-04", "2024-04", 1), ("c", "2024-02", "2024-04", 3), ("d", "2024-02", "2024-04", 3)]
    wide = ranges(frame, first=DAY(2000, 1, 1), last=DAY(2099, 12, 1))
    assert ("b", "2000-01", "2023-10", 286) in wide and ("b", "2024-07", "2099-12", 906) in wide and len(wide) == 2 + 2 + 1 + 2 + 2
    assert ranges(frame.limit(0)) == [] and ranges(frame.filter("s = 'c'")) == []


def test_ranges_are_the_months_that_are_missing(spark):
    frame = spark.range(400).select(
        (F.col("id") % 7).alias("s"), (2019 + F.xxhash64("id") % 3).cast("int").alias("y"),
        (1 + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(12))).cast("int").alias("m")).filter("y >= 2019 and (s + m) % 3 <> 0")
    one_by_one = {(r["s"], r["mes_ausente"]) for r in outages.missing_months(frame, ["s"], "y", "m").collect()}
    stretches = outages.missing_ranges(frame, ["s"], "y", "m")
    spread = stretches.select("s", F.explode(F.expr("sequence(primeiro_mes, ultimo_mes, interval 1 month)")).alias("d"))
    assert {(r["s"], r["d"]) for r in spread.collect()} == one_by_one and spread.count() == len(one_by_one)
    assert stretches.agg(F.sum("meses")).first()[0] == len(one_by_one)


def test_limits_in_force(spark):
    limits = spark.createDataFrame([
        ("a", DAY(2024, 1, 1), 5.0), ("a", DAY(2024, 6, 15), 3.0), ("a", None, 0.1), ("a", DAY(2023, 1, 1), None),
        ("b", DAY(2024, 7, 1), 4.0), ("b", DAY(2024, 7, 1), 2.0), ("unasked", DAY(2024, 1, 1), 1.0),
    ], "distribuidora string, valido_desde date, limite_dec double")
    readings = spark.createDataFrame([
        ("a", DAY(2023, 12, 1), 9.0), ("a", DAY(2024, 1, 1), 9.0), ("a", DAY(2024, 6, 1), 4.0), ("a", DAY(2024, 7, 1), 4.0),
        ("a", DAY(2024, 8, 1), None), ("b", DAY(2024, 6, 1), 9.0), ("b", DAY(2024, 7, 1), 3.0), ("none", DAY(2024, 7, 1), 3.0),
        (None, DAY(2024, 7, 1), 3.0), ("a", None, 1.0), ("a", DAY(2024, 7, 1), 4.0),
    ], "distribuidora string, quando date, dec_medio double")
    held = compare.limit_as_of(readings, limits, "dec_medio", "quando").collect()
    found = sorted([(str(r[0]), str(r[1]), r["limite_dec"], r["excesso"], r["situacao"]) for r in held], key=str)
    assert found == sorted([
        ("a", "2023-12-01", None, None, "SEM_LIMITE"), ("a", "2024-01-01", 5.0, 4.0, "ACIMA"), ("a", "2024-06-01", 5.0, None, "DENTRO"),
        ("a", "2024-07-01", 3.0, 1.0, "ACIMA"), ("a", "2024-07-01", 3.0, 1.0, "ACIMA"), ("a", "2024-08-01", 3.0, None, "SEM_MEDICAO"),
        ("b", "2024-06-01", None, None, "SEM_LIMITE"), ("b", "2024-07-01", 2.0, 1.0, "ACIMA"), ("none", "2024-07-01", None, None, "SEM_LIMITE"),
        ("None", "2024-07-01", None, None, "SEM_LIMITE"), ("a", "None", None, None, "SEM_LIMITE")], key=str)
    plan = compare.limit_as_of(readings, limits, "dec_medio", "quando")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert compare.limit_as_of(readings.limit(0), limits, "dec_medio", "quando").count() == 0
    assert {r["situacao"] for r in compare.limit_as_of(readings, limits.limit(0), "dec_medio", "quando").collect()} == {"SEM_LIMITE"}


SERIES = {
    "steady": [10.0 + k % 3 for k in range(24)] + [30.0],
    "flat": [5.0] * 13 + [5.5, 5.0, 4.0],
    "mostly flat": [5.0] * 8 + [6.0, 4.0, 5.0, 7.0],
    "gaps": [10.0, 11.0, None, 12.0, 10.0, 11.0, None, 12.0, 40.0],
    "short": [1.0, 1.0, 1.0, 1.0, 1.0, 99.0],
}


def test_robust_jumps(spark):
    start = 2020 * 12
    rows = [(name, (start + k) // 12, (start + k) % 12 + 1, x) for name, own in SERIES.items() for k, x in enumerate(own)]
    rows = [r for r in rows if r[0] != "gaps" or r[3] is not None] + [("steady", 2030, 1, 99.0), ("gaps", 2020, 3, None)]
    frame = spark.createDataFrame(rows, "distribuidora string, ano long, mes long, dec_medio double")
    want = {}
    for name, year, month, x in rows:
        if x is None:
            continue
        past = [v for n, y, m, v in rows if n == name and v is not None and 1 <= (year * 12 + month) - (y * 12 + m) <= 12]
        if len(past) < 6:
            continue
        base = median(past)
        mad = median([abs(v - base) for v in past])
        if x > base and (mad == 0 or (x - base) / (mad * 1.4826) > 3.5):
            want[name, year, month] = (len(past), base, mad, (x - base) / (mad * 1.4826) if mad else None)
    found = {(r["distribuidora"], r["ano"], r["mes"]): (r["historico"], r["mediana"], r["mad"], r["desvios"])
             for r in indicators.robust_jumps(frame).collect()}
    assert found == want
    # a month a decade later has no history; a single rise over a flat series counts, one below it does not
    assert {k[0] for k in want} == {"steady", "flat", "mostly flat", "gaps"} and ("steady", 2030, 1) not in want
    assert indicators.robust_jumps(frame.limit(0)).count() == 0


def test_cause_tree(spark):
    rows = [("x", "p", 60, 3), ("x", "p", 60, 1), ("x", "q", None, 5), ("y", None, -60, None), (None, None, 120, 2)]
    frame = spark.createDataFrame(rows, "l1 string, l2 string, s int, n int").select(
        "l1", "l2", "n", F.lit("2024-01-01").cast("timestamp_ntz").alias("a")).withColumn("b", F.col("a"))
    tree = profiling.cause_rollup(frame, ["l1", "l2"], "a", "b", "n")
    found = {(r["nivel"], r["l1"], r["l2"]): (r["qtd_eventos"], r["consumidores_afetados"]) for r in tree.collect()}
    assert found == {
        (0, None, None): (5, 11), (1, "x", None): (3, 9), (1, "y", None): (1, None), (1, None, None): (1, 2),
        (2, "x", "p"): (2, 4), (2, "x", "q"): (1, 5), (2, "y", None): (1, None), (2, None, None): (1, 2)}
    again = profiling.cause_rollup(frame, ["l1", "l2"], "a", "b", "n")
    assert again._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert profiling.cause_rollup(frame.limit(0), ["l1", "l2"], "a", "b", "n").filter("nivel > 0").count() == 0


def test_null_drops(spark):
    frame = spark.createDataFrame([(1, None, 3), (None, None, 3), (1, 2, None), (1, 2, 3)], "a int, b int, c int")
    found = [tuple(r) for r in filters.null_drops(frame, ["a", "b", "c"]).collect()]
    assert found == [("a", 1, 3), ("b", 1, 2), ("c", 1, 1)]
    assert filters.drop_nulls(frame, ["a", "b", "c"]).count() == found[-1][2]
    assert [tuple(r) for r in filters.null_drops(frame.limit(0), ["a"]).collect()] == [("a", 0, 0)]


def test_sketch_states_follow_their_year(spark, tmp_path):
    from outagelens.sources import tables

    path = str(tmp_path / "states")
    rows = spark.range(60_000).select((2020 + F.col("id") % 3).cast("int").alias("ano"), "id")
    tables.replace_all(sketches.year_states(rows, "ano", F.col("id"), F.col("id")), path, "ano")
    stored = spark.read.schema(sketches.STATES + ", ano INT")
    assert sketches.distinct_from_states(stored.parquet(path)).first()[0] == pytest.approx(60_000, rel=0.05)
    halves = {"half": 0.5}
    assert sketches.quantiles_from_states(stored.parquet(path), halves).first()[0] == pytest.approx(30_000, abs=1_500)
    fewer = rows.filter("ano = 2021").selectExpr("ano", "id % 100 as id")
    tables.replace_years(sketches.year_states(fewer, "ano", F.col("id"), F.col("id")), path, "ano", [2021])
    assert sketches.distinct_from_states(stored.parquet(path)).first()[0] == pytest.approx(40_067, rel=0.05)
    assert stored.parquet(path).agg(F.sum("linhas")).first()[0] == 60_000
    low = sketches.quantiles_from_states(stored.parquet(path).filter("ano = 2021"), halves).first()[0]
    assert 45 <= low <= 54
    wrong = spark.createDataFrame([(55_000,)], "half long")
    assert not sketches.quantile_check(rows, F.col("id"), wrong, halves, 0.025).first()["within_bound"]
    assert sketches.distinct_from_states(stored.parquet(path).limit(0)).first()[0] in (0, None)
