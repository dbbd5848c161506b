"""Observed against published continuity indices, limits and regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from outagelens import vocabulary as v
from outagelens.functions import durations
from outagelens.operators.conform import enrich_region

MONTH_KEY = ["distribuidora", "ano", "mes"]


def observed_month(
    events: DataFrame,
    agent: str = "SigAgente",
    start: str = "DatInicioInterrupcao",
    end: str = "DatFimInterrupcao",
    affected: str = "NumUnidadeConsumidora",
    conjunto: str = "IdeConjuntoUnidadeConsumidora",
    served: str = "NumConsumidorConjunto",
) -> DataFrame:
    """Per distributor and month: consumers affected, consumer-seconds, consumers served.

    Two levels: per conjunto first, where the number served is the largest reported,
    then summed. Each level shuffles partial aggregates only; sums are integers.
    """
    seconds = durations.elapsed_seconds(start, end)
    per_conjunto = events.groupBy(
        F.trim(agent).alias("distribuidora"),
        F.year(start).cast("bigint").alias("ano"),
        F.month(start).cast("bigint").alias("mes"),
        F.col(conjunto).alias("_conjunto"),
    ).agg(
        F.sum(F.col(affected) * seconds).alias("_seconds"),
        F.sum(affected).alias("_affected"),
        F.count(F.lit(1)).alias("_events"),
        F.max(served).alias("_served"),
    )
    return per_conjunto.groupBy(*MONTH_KEY).agg(
        F.sum("_seconds").alias("consumidor_segundos"),
        F.sum("_affected").alias("consumidores_afetados"),
        F.sum("_events").alias("total_eventos"),
        F.sum("_served").alias("consumidores_eventos"),
    )


INDEX_CODES = ["DEC", "FEC", "NumCon"]


def official_month(conjuntos: DataFrame) -> DataFrame:
    """Published figures per distributor and month.

    ``conjuntos`` has one row per conjunto and month with ``INDEX_CODES`` as columns. The
    weighted index counts each conjunto by its consumers, over conjuntos that report
    both; the plain mean is kept beside it.
    """
    dec, fec, numcon = F.col("dec"), F.col("fec"), F.col("numcon")
    return conjuntos.groupBy(*MONTH_KEY).agg(
        F.sum(numcon).alias("consumidores"),
        F.try_divide(
            F.sum(dec * numcon), F.sum(F.when(dec.isNotNull(), numcon))
        ).alias("dec_oficial"),
        F.try_divide(
            F.sum(fec * numcon), F.sum(F.when(fec.isNotNull(), numcon))
        ).alias("fec_oficial"),
        F.avg(dec).alias("dec_medio"),
        F.avg(fec).alias("fec_medio"),
    )


def _served(observed: DataFrame, official: DataFrame | None) -> DataFrame:
    """Attach the published number of consumers; events supply it where none is published."""
    if official is None:
        return observed.withColumn("consumidores", F.col("consumidores_eventos").cast("double"))
    published = official.select(*MONTH_KEY, F.col("consumidores").alias("_published"))
    return observed.join(published, MONTH_KEY, "left").withColumn(
        "consumidores",
        F.coalesce(F.col("_published"), F.col("consumidores_eventos").cast("double")),
    )


def dec_observed(observed: DataFrame, official: DataFrame | None = None) -> DataFrame:
    """Hours without supply per consumer served, per distributor and month."""
    return _served(observed, official).select(
        *MONTH_KEY,
        "consumidores",
        F.try_divide(
            F.col("consumidor_segundos") / F.lit(3600.0), F.col("consumidores")
        ).alias("dec_observado"),
    )


def fec_observed(observed: DataFrame, official: DataFrame | None = None) -> DataFrame:
    """Interruptions per consumer served, per distributor and month."""
    return _served(observed, official).select(
        *MONTH_KEY,
        "consumidores",
        F.try_divide(
            F.col("consumidores_afetados").cast("double"), F.col("consumidores")
        ).alias("fec_observado"),
    )


def dec_comparison(
    observed: DataFrame,
    official: DataFrame,
    warn: float = v.WARN_PERCENT,
    crit: float = v.CRITICAL_PERCENT,
) -> DataFrame:
    """Observed beside published DEC with difference, percentage and alert level.

    Full outer: a month only one side knows is shown too. Both sides are monthly totals
    when they meet, so the join is small whatever the number of events.
    """
    joined = observed.join(official, MONTH_KEY, "full")
    served = F.coalesce(F.col("consumidores"), F.col("consumidores_eventos").cast("double"))
    hours = F.col("consumidor_segundos") / F.lit(3600.0)
    joined = joined.select(
        *MONTH_KEY,
        F.try_divide(hours, served).alias("dec_observado"),
        "dec_oficial",
        "dec_medio",
    )
    gap = F.col("dec_observado") - F.col("dec_oficial")
    joined = joined.withColumns(
        {
            "diferenca": gap,
            "diferenca_perc": F.try_divide(gap, F.col("dec_oficial")) * F.lit(100.0),
        }
    )
    size = F.abs("diferenca_perc")
    return joined.withColumn(
        "alerta",
        F.when(F.coalesce(F.col("dec_oficial"), F.lit(0.0)) == 0, "NO_REFERENCE")
        .when(F.col("dec_observado").isNull(), "NO_OBSERVATION")
        .when(size > crit, "CRITICAL")
        .when(size > warn, "WARNING")
        .otherwise("OK"),
    )


def above_limit(
    yearly: DataFrame, limits: DataFrame, value: str = "dec_medio"
) -> DataFrame:
    """Distributors and years whose index exceeds the limit set for them.

    ``limits`` holds (distribuidora, limite_dec), and ``ano`` if limits differ by year;
    without it a limit holds in every year of ``yearly``. No hint: its size decides the join.
    """
    keys = [c for c in ("distribuidora", "ano") if c in limits.columns]
    joined = yearly.join(limits, keys, "left")
    return joined.filter(F.col(value) > F.col("limite_dec")).withColumn(
        "excesso", F.col(value) - F.col("limite_dec")
    )


def limit_as_of(
    readings: DataFrame, limits: DataFrame, value: str, date: str, agent: str = "distribuidora"
) -> DataFrame:
    """Readings with the limit in force on their date, and how they stand to it.

    ``limits`` holds (agent, valido_desde, limite_dec); a limit holds from its day until the
    next one of its agent. Both tables stand in one sequence per agent, by date, and every
    reading takes the last limit before it or on its day: no product of readings and limits,
    one exchange by agent. Readings are monthly figures, so an agent has few of them.

    Adds valido_desde, limite_dec, excesso and situacao: ACIMA, DENTRO, SEM_LIMITE (no limit
    yet, or agent without one) or SEM_MEDICAO. Every reading stays. Limits without a day or a
    value never hold; of several on one day the strictest does.
    """
    names = readings.columns
    given = limits.filter("valido_desde is not null and limite_dec is not null").select(
        F.col(agent).alias("_agent"), F.col("valido_desde").cast("date").alias("_day"),
        F.struct(F.col("valido_desde").cast("date").alias("day"), F.col("limite_dec").cast("double").alias("limit")).alias("_limit"))
    asked = readings.select(
        F.col(agent).alias("_agent"), F.col(date).cast("date").alias("_day"), F.struct(*names).alias("_reading"))
    both = given.withColumn("_reading", F.lit(None).cast(asked.schema["_reading"].dataType)).unionByName(
        asked.withColumn("_limit", F.lit(None).cast(given.schema["_limit"].dataType)))
    # a limit of the same day comes before the reading, the strictest last
    in_time = (
        Window.partitionBy("_agent")
        .orderBy(F.col("_day").asc_nulls_first(), F.col("_reading").isNotNull(), F.col("_limit.limit").desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    held = both.withColumn("_held", F.last("_limit", ignorenulls=True).over(in_time)).filter("_reading is not null")
    limit = F.col("_held.limit")
    joined = held.select("_reading.*", F.col("_held.day").alias("valido_desde"), limit.alias("limite_dec"))
    above = F.col(value) > F.col("limite_dec")
    return joined.withColumns({
        "excesso": F.when(above, F.col(value) - F.col("limite_dec")),
        "situacao": F.when(F.col("limite_dec").isNull(), "SEM_LIMITE").when(F.col(value).isNull(), "SEM_MEDICAO")
        .when(above, "ACIMA").otherwise("DENTRO"),
    })


def fec_by_region(conjuntos: DataFrame, mapping: DataFrame) -> DataFrame:
    """Mean FEC per region and distributor; the mapping meets one row per distributor."""
    means = conjuntos.groupBy("distribuidora").agg(
        F.avg("fec").alias("fec_medio"), F.count("fec").alias("medicoes")
    )
    return enrich_region(means, mapping, "distribuidora").select(
        "regiao", "distribuidora", "fec_medio", "medicoes"
    )
