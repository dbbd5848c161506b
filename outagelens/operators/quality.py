"""Checks and reconciliations that return findings; ``require`` alone acts on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outagelens.functions import durations, text
from outagelens.operators.dedupe import dedupe_audit

PASS, FAIL, WARN, INFO = "PASS", "FAIL", "WARN", "INFO"


def _unpivot(one_row: DataFrame, entries: list[Column]) -> DataFrame:
    """A row of metrics to one row per metric; ``entries`` are structs."""
    return one_row.select(F.inline(F.array(*entries)))


def _finding(name: str, metric: Column, allowed: float = 0.0, soft: bool = False) -> Column:
    """Passes while the metric does not exceed what is allowed."""
    return F.struct(
        F.lit(name).alias("verificacao"),
        F.when(metric <= F.lit(allowed), PASS).otherwise(WARN if soft else FAIL).alias("status"),
        metric.cast("double").alias("metrica"),
        F.lit(allowed).cast("double").alias("limite"),
    )


def check_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """One row per required column: is it there, and in how many rows is it filled."""
    there = [c for c in required if c in df.columns]
    filled = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(f"_{c}") for c in there]
    )
    return _unpivot(
        filled,
        [
            F.struct(
                F.lit(c).alias("coluna"),
                F.lit(c in there).alias("presente"),
                (F.col(f"_{c}") if c in there else F.lit(0).cast("bigint")).alias("preenchidos"),
                F.col("_rows").alias("linhas"),
            )
            for c in required
        ],
    )


def check_report(
    df: DataFrame,
    columns: list[str] | None = None,
    key: list[str] | None = None,
    not_null: list[str] | None = None,
    ranges: dict[str, tuple[float | None, float | None]] | None = None,
    domains: dict[str, list[str]] | None = None,
    conditions: dict[str, Column] | None = None,
    soft: tuple[str, ...] = (),
    totals: dict[str, Column] | None = None,
) -> DataFrame:
    """All checks of a table in one pass: (verificacao, status, metrica, limite).

    The metric is a number of offending rows (or keys); every one is allowed zero.
    Rules on absent columns are reported by the column check and skipped. ``conditions``
    are named expressions true for an offending row; names in ``soft`` only warn.
    ``totals`` are named integer expressions summed beside the checks, status INFO.

    With a ``key`` the counts are partial sums per key inside the same aggregation that
    finds repeated keys, so uniqueness adds no second pass.
    """
    have = set(df.columns)
    absent = [c for c in columns or [] if c not in have]
    rules: dict[str, Column] = {}
    for c in not_null or []:
        if c in have:
            rules[f"nulos:{c}"] = F.col(c).isNull()
    for c, (low, high) in (ranges or {}).items():
        if c in have:
            outside = F.lit(False)
            if low is not None:
                outside = outside | (F.col(c) < low)
            if high is not None:
                outside = outside | (F.col(c) > high)
            rules[f"faixa:{c}"] = outside
    for c, allowed in (domains or {}).items():
        if c in have:
            rules[f"dominio:{c}"] = ~F.col(c).isin(allowed)
    rules.update(conditions or {})
    counts = [F.count_if(rule).alias(f"_r{i}") for i, rule in enumerate(rules.values())]
    sums = dict(totals or {})
    counts += [F.sum(value).alias(f"_t{i}") for i, value in enumerate(sums.values())]
    use_key = bool(key) and set(key) <= have
    if use_key:
        per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), *counts)
        result = per_key.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"),
            F.count_if(F.col("_n") > 1).alias("_repeated"),
            *[F.coalesce(F.sum(f"_r{i}"), F.lit(0)).alias(f"_r{i}") for i in range(len(rules))],
            *[F.sum(f"_t{i}").alias(f"_t{i}") for i in range(len(sums))],
        )
    else:
        result = df.agg(F.count(F.lit(1)).alias("_rows"), *counts)
    entries = [_finding(f"coluna_ausente:{c}", F.lit(1)) for c in absent]
    entries.append(_finding("sem_linhas", F.when(F.col("_rows") == 0, 1).otherwise(0)))
    if use_key:
        entries.append(_finding("chaves_repetidas", F.col("_repeated")))
    entries += [
        _finding(name, F.col(f"_r{i}"), soft=name in soft) for i, name in enumerate(rules)
    ]
    entries += [
        F.struct(
            F.lit(f"total:{name}").alias("verificacao"),
            F.lit(INFO).alias("status"),
            F.coalesce(F.col(f"_t{i}"), F.lit(0)).cast("double").alias("metrica"),
            F.lit(None).cast("double").alias("limite"),
        )
        for i, name in enumerate(sums)
    ]
    return _unpivot(result, entries)


def require(report: DataFrame) -> dict[str, float]:
    """Raise if any finding failed; else the metrics by name, one row per rule."""
    findings = report.collect()
    failed = [r for r in findings if r["status"] == FAIL]
    if failed:
        listed = ", ".join(f"{r['verificacao']}={r['metrica']:g}" for r in failed)
        raise ValueError(f"checks failed: {listed}")
    return {r["verificacao"]: r["metrica"] for r in findings}


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("qtd")).filter(F.col("qtd") > 1)


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: keys, repeated keys, rows in repeated keys."""
    many = F.col("qtd") > 1
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("qtd"))
        .agg(
            F.count(F.lit(1)).alias("chaves"),
            F.count_if(many).alias("chaves_repetidas"),
            F.coalesce(F.sum(F.when(many, F.col("qtd"))), F.lit(0)).alias("linhas_envolvidas"),
        )
    )


def check_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls per critical column, all columns in one aggregate."""
    totals = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _unpivot(
        totals,
        [F.struct(F.lit(c).alias("coluna"), F.col(c).alias("qtd_nulos")) for c in columns],
    )


def check_range(df: DataFrame, column: str) -> DataFrame:
    """Rows with a missing or negative value."""
    value = F.col(column)
    return df.agg(
        F.count(F.lit(1)).alias("linhas"),
        F.count_if(value.isNull()).alias("nulos"),
        F.count_if(value < 0).alias("negativos"),
    )


def check_duration(df: DataFrame, start: str, end: str, minutes: str) -> DataFrame:
    """Negative durations, and missing ones although both stamps are known."""
    known = F.col(start).isNotNull() & F.col(end).isNotNull()
    return df.agg(
        F.count_if(F.col(minutes) < 0).alias("negativas"),
        F.count_if(known & F.col(minutes).isNull()).alias("nulas_invalidas"),
    )


def check_classes(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Rows, classified rows, rows outside the allowed classes."""
    return df.agg(
        F.count(F.lit(1)).alias("linhas"),
        F.count(column).alias("classificadas"),
        F.count_if(~F.col(column).isin(allowed)).alias("invalidas"),
    )


def null_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls per key column as one wide row."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"nulos_{c}") for c in columns])


def class_distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows and share per class; the total is a window over one row per class."""
    per_class = df.groupBy(column).agg(F.count(F.lit(1)).alias("qtd_registros"))
    everything = F.sum("qtd_registros").over(Window.partitionBy())
    return per_class.withColumn("pct", text.share(F.col("qtd_registros"), everything))


def reconcile_counts(
    bronze: DataFrame, keys: list[str], required: str
) -> DataFrame:
    """Rows of each stage from one aggregation: read, with a start, distinct by key."""
    usable = F.when(F.col(required).isNotNull(), 1).otherwise(0)
    per_key = bronze.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_all"), F.sum(usable).alias("_usable")
    )
    return per_key.agg(
        F.coalesce(F.sum("_all"), F.lit(0)).alias("bronze"),
        F.coalesce(F.sum("_usable"), F.lit(0)).alias("conformado"),
        F.count_if(F.col("_usable") > 0).alias("silver"),
        F.coalesce(F.sum(F.col("_all") - F.col("_usable")), F.lit(0)).alias("excluidos_data_nula"),
        F.coalesce(
            F.sum(F.greatest(F.col("_usable") - 1, F.lit(0))), F.lit(0)
        ).alias("duplicatas_removidas"),
    )


def _gap(pair: DataFrame, tolerance_pct: float) -> DataFrame:
    """Two sums in seconds to minutes, their difference and a verdict."""
    left, right = F.col("_left"), F.col("_right")
    gap = F.abs(left - right)
    pct = F.when(left > 0, gap / left * F.lit(100.0)).otherwise(F.lit(0.0))
    return pair.select(
        (left / F.lit(60.0)).alias("soma_origem"),
        (right / F.lit(60.0)).alias("soma_destino"),
        (gap / F.lit(60.0)).alias("diferenca"),
        pct.alias("diferenca_perc"),
        F.when(pct > tolerance_pct, FAIL).otherwise(PASS).alias("status"),
    )


def reconcile_dedupe_sum(
    df: DataFrame, keys: list[str], order: list[str], minutes: str, tolerance_pct: float = 1.0
) -> DataFrame:
    """Sum of minutes before and after deduplication, from the dedupe's own pass."""
    seconds = F.coalesce(durations.exact_seconds(F.col(minutes)), F.lit(0))
    audit = dedupe_audit(df.withColumn("_seconds", seconds), keys, order, "_seconds")
    return _gap(
        audit.select(F.col("sum_before").alias("_left"), F.col("sum_after").alias("_right")),
        tolerance_pct,
    )


def reconcile_sum(
    left: DataFrame, right: DataFrame, minutes: str, right_minutes: str, tolerance_pct: float
) -> DataFrame:
    """Sum of minutes in two tables, as exact seconds, against a tolerance in percent.

    Each table is reduced to partial sums where it lies; the two meet as single rows.
    """

    def seconds(df: DataFrame, column: str, side: str) -> DataFrame:
        return df.agg(
            F.coalesce(F.sum(durations.exact_seconds(F.col(column))), F.lit(0)).alias("_s")
        ).withColumn("_side", F.lit(side))

    both = seconds(left, minutes, "l").unionByName(seconds(right, right_minutes, "r"))
    pair = both.agg(
        F.sum(F.when(F.col("_side") == "l", F.col("_s"))).alias("_left"),
        F.sum(F.when(F.col("_side") == "r", F.col("_s"))).alias("_right"),
    )
    return _gap(pair, tolerance_pct)


def reconcile_steps(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    start: str,
    end: str,
    min_retained: float = 95.0,
) -> DataFrame:
    """Rows after each rule with reduction and share of the first step.

    The newest row of every key comes from one aggregation that also counts what it
    replaced, and the later steps are conditions on that row; the source is read once.
    """
    newest = F.max_by(F.struct(start, end), F.struct(*order))
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), newest.alias("_row"))
    s, e = F.col(f"_row.{start}"), F.col(f"_row.{end}")
    valid = ~F.coalesce(e <= s, F.lit(False))
    steps = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_0"),
        F.count(F.lit(1)).alias("_1"),
        F.count_if(valid).alias("_2"),
        F.count_if(valid & s.isNotNull() & e.isNotNull()).alias("_3"),
        F.count_if(valid).alias("_4"),
    )
    names = ["bronze", "deduplicado", "temporal_valido", "com_duracao", "final"]
    listed = _unpivot(
        steps,
        [
            F.struct(
                F.lit(i + 1).alias("passo"),
                F.lit(name).alias("etapa"),
                F.col(f"_{i}").alias("qtd_registros"),
                F.greatest(F.col("_0") - F.col(f"_{i}"), F.lit(0)).alias("reducao"),
                text.share(F.col(f"_{i}"), F.col("_0")).alias("pct_retencao"),
            )
            for i, name in enumerate(names)
        ],
    )
    return listed.withColumn("aceitavel", F.col("pct_retencao") >= min_retained)


def filtered_share(before: DataFrame, kept: Column) -> DataFrame:
    """Rows before, kept, dropped and the share dropped, in one pass over the source."""
    counts = before.agg(F.count(F.lit(1)).alias("bronze"), F.count_if(kept).alias("silver"))
    dropped = F.col("bronze") - F.col("silver")
    return counts.select(
        "bronze",
        "silver",
        dropped.alias("filtrados"),
        text.share(dropped, F.col("bronze")).alias("perc_filtrado"),
    )
