"""Monthly outage totals per distributor and the questions asked of them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outagelens import vocabulary as v
from outagelens.functions import calendar, durations
from outagelens.operators.ranking import top_k


def gold_outage_month(
    df: DataFrame,
    agent: str = "cod_distribuidora",
    start: str = "data_inicio",
    minutes: str = "tempo_interrupcao_minutos",
    clip_negative: bool = False,
    run_ts: dt.datetime | None = None,
) -> DataFrame:
    """Total time, number and first and last start of events per distributor and month.

    A missing duration counts zero; negative ones are summed as they are unless
    ``clip_negative``. One exchange of partial aggregates on the gold key, so a
    distributor with a third of all events costs one row per month and map task.
    """
    seconds = F.coalesce(durations.exact_seconds(F.col(minutes)), F.lit(0))
    if clip_negative:
        seconds = F.greatest(seconds, F.lit(0))
    totals = df.groupBy(
        F.col(agent).alias("cod_distribuidora"),
        F.year(start).alias("ano_referencia"),
        F.month(start).alias("mes_referencia"),
    ).agg(
        F.sum(seconds).alias("_seconds"),
        F.count(F.lit(1)).alias("total_eventos"),
        F.min(start).alias("data_primeiro_evento"),
        F.max(start).alias("data_ultimo_evento"),
    )
    gold = totals.select(
        *v.OUTAGE_MONTH_KEY,
        (F.col("_seconds") / F.lit(60.0)).alias("tempo_total_minutos"),
        F.round(F.col("_seconds") / F.lit(3600.0), 2).alias("tempo_total_horas"),
        "total_eventos",
        "data_primeiro_evento",
        "data_ultimo_evento",
    )
    return gold if run_ts is None else gold.withColumn("_gold_timestamp", F.lit(run_ts))


def _hours(minutes: str = "tempo_total_minutos"):
    return F.round(F.sum(durations.exact_seconds(F.col(minutes))) / F.lit(3600.0), 2)


def worst_distributors(gold: DataFrame, year: int, k: int = 1) -> DataFrame:
    """Distributors with most interruption time in a year."""
    yearly = (
        gold.filter(F.col("ano_referencia") == year)
        .groupBy("cod_distribuidora")
        .agg(_hours().alias("horas"), F.sum("total_eventos").alias("eventos"))
    )
    return top_k(yearly, by="horas", k=k, ties=["cod_distribuidora"])


def monthly_trend(gold: DataFrame, agent: str | None = None) -> DataFrame:
    """Hours and events month by month with the hours of the row before.

    The window runs over monthly rows, of which a distributor has as many as there are
    months on record.
    """
    rows = gold if agent is None else gold.filter(F.col("cod_distribuidora") == agent)
    by_month = Window.partitionBy("cod_distribuidora").orderBy("ano_referencia", "mes_referencia")
    return rows.select(
        *v.OUTAGE_MONTH_KEY,
        "tempo_total_horas",
        "total_eventos",
        F.lag("tempo_total_horas").over(by_month).alias("horas_mes_anterior"),
    )


def events_by_month(gold: DataFrame) -> DataFrame:
    return gold.groupBy("ano_referencia", "mes_referencia").agg(
        F.sum("total_eventos").alias("eventos")
    )


def missing_months(
    df: DataFrame, keys: list[str], year: str, month: str,
    first: dt.date | None = None, last: dt.date | None = None,
) -> DataFrame:
    """Months between ``first`` and ``last`` for which a series has no row.

    Without bounds the period is that of the whole table, read by a scalar subquery from
    the same aggregation. Each series collapses to its set of months, as many as the
    period has, in map-side partials; only absent months are ever written out as rows.
    """
    date = calendar.month_start(F.col(year), F.col(month))
    series = df.groupBy(*keys).agg(F.collect_set(date).alias("_have"))
    span = series.agg(
        F.struct(
            F.min(F.array_min("_have")).alias("lo"), F.max(F.array_max("_have")).alias("hi")
        )
    ).scalar()
    lo = F.lit(first) if first else span.getField("lo")
    hi = F.lit(last) if last else span.getField("hi")
    period = F.sequence(lo, hi, F.expr("interval 1 month"))
    return series.select(
        *keys, F.explode(F.array_except(period, F.col("_have"))).alias("mes_ausente")
    )


def missing_ranges(
    df: DataFrame, keys: list[str], year: str, month: str,
    first: dt.date | None = None, last: dt.date | None = None,
) -> DataFrame:
    """Stretches of months between ``first`` and ``last`` without a row of a series.

    One row per stretch: the keys, primeiro_mes, ultimo_mes and meses, their number. Without
    bounds the period is that of the whole table. Each series is reduced to its distinct
    months before they are put in order, so a series with a third of all rows has no more of
    them than the period; the result grows with the gaps and not with the calendar.

    Defined results: rows whose month is unknown or outside the bounds only tell that the
    series exists; a series without any month inside them misses the whole period.
    """
    valid = F.col(month).between(1, 12)
    number = F.when(valid, calendar.month_number(F.col(year), F.col(month) - 1))
    months = df.select(*keys, number.alias("_m")).distinct()
    span = months.agg(F.struct(F.min("_m").alias("lo"), F.max("_m").alias("hi"))).scalar()
    lo = F.lit(first.year * 12 + first.month - 1) if first else span.getField("lo")
    hi = F.lit(last.year * 12 + last.month - 1) if last else span.getField("hi")
    inside = F.coalesce(F.least(F.greatest("_m", lo - 1), hi + 1), lo - 1)
    in_order = Window.partitionBy(*keys).orderBy("_m")
    steps = months.withColumn("_m", inside).withColumns({
        "_before": F.coalesce(F.lag("_m").over(in_order) + 1, lo),
        "_after": F.when(F.lead("_m").over(in_order).isNull(), hi),
    })
    gaps = F.array(
        F.struct(F.col("_before").alias("a"), (F.col("_m") - 1).alias("b")),
        F.struct((F.col("_m") + 1).alias("a"), F.col("_after").alias("b")),
    )

    def day(n: Column) -> Column:
        return F.make_date(F.floor(n / 12).cast("int"), (n % 12 + 1).cast("int"), F.lit(1))

    return steps.select(*keys, F.inline(gaps)).filter("a <= b").select(
        *keys, day(F.col("a")).alias("primeiro_mes"), day(F.col("b")).alias("ultimo_mes"),
        (F.col("b") - F.col("a") + 1).cast("bigint").alias("meses"))
