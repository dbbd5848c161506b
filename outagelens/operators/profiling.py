"""Profiles of a table, every column or rule in a single pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outagelens import vocabulary as v
from outagelens.functions import durations, text
from outagelens.operators.filters import reversed_or_empty
from outagelens.operators.ranking import count_by, top_k

def _per_column(df: DataFrame, names: list[str], rule, column_name: str, pct_name: str) -> DataFrame:
    totals = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(rule(F.col(c))).alias(f"_{c}") for c in names]
    )
    return totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("coluna"),
                        F.col(f"_{c}").alias(column_name),
                        text.share(F.col(f"_{c}"), F.col("_rows")).alias(pct_name),
                    )
                    for c in names
                ]
            )
        )
    ).orderBy(F.desc(pct_name), "coluna")


def profile_nulls(df: DataFrame) -> DataFrame:
    """Nulls and their share for every column, most incomplete first."""
    return _per_column(df, df.columns, lambda c: c.isNull(), "qtd_nulos", "pct_nulos")


def profile_blanks(df: DataFrame) -> DataFrame:
    """Empty texts and their share for every text column that has any."""
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    found = _per_column(df, names, text.blank, "qtd_vazias", "pct_vazias")
    return found.filter(F.col("qtd_vazias") > 0)


def profile_temporal(df: DataFrame, start: str, end: str) -> DataFrame:
    counts = df.agg(
        F.count(F.lit(1)).alias("linhas"),
        F.count_if(reversed_or_empty(start, end)).alias("qtd_inconsistentes"),
    )
    return counts.withColumn("pct", text.share(F.col("qtd_inconsistentes"), F.col("linhas")))


def profile_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Repeated keys, the rows in them, and the worst key."""
    worst = F.struct(*[F.col(k).cast("string").alias(k) for k in keys])
    repeated = count_by(df, *keys, name="_n").filter(F.col("_n") > 1)
    return repeated.agg(
        F.count(F.lit(1)).alias("chaves_repetidas"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("linhas_envolvidas"),
        F.max("_n").alias("maior_repeticao"),
        F.max_by(F.concat_ws("#", worst[keys[0]], *[worst[k] for k in keys[1:]]),
                 F.struct("_n", worst)).alias("pior_chave"),
    )


def duplicate_examples(df: DataFrame, keys: list[str], k: int = 1) -> DataFrame:
    """All rows of the ``k`` most repeated keys.

    The keys are a top-k list, so the side that meets the table is ``k`` rows.
    """
    worst = top_k(
        count_by(df, *keys, name="_n").filter(F.col("_n") > 1), by="_n", k=k, ties=keys
    )
    return df.join(worst.select(*keys), keys, "left_semi")


def exact_percentiles(df: DataFrame, value: str, points: dict[str, int], width: int) -> DataFrame:
    """Exact percentiles of an integer column as one row: the smallest value whose rank
    reaches the given percentage of the rows. Also their number and sum.

    Equal values are counted first, in map-side partials. The counts are then cumulated
    inside buckets of ``width`` values, so that no window sees more than ``width`` rows,
    and across the buckets, of which there are as many as the range of values holds
    widths. A sketch would be one pass, but one sketch per map task meets in one reducer.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("_v")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    bucket = F.floor(F.col("_v") / F.lit(width))
    counted = counted.withColumn("_b", bucket)
    up_to = Window.partitionBy(F.lit(0)).orderBy("_b")
    buckets = counted.groupBy("_b").agg(F.sum("_n").alias("_size")).select(
        "_b",
        (F.sum("_size").over(up_to) - F.col("_size")).alias("_before"),
        F.sum("_size").over(Window.partitionBy(F.lit(0))).alias("_total"),
    )
    inside = Window.partitionBy("_b").orderBy("_v")
    ranked = counted.withColumn("_within", F.sum("_n").over(inside)).join(buckets, "_b", "left")
    reached = F.col("_before") + F.col("_within")
    return ranked.agg(
        *[
            F.min(F.when(reached * 100 >= F.col("_total") * p, F.col("_v"))).alias(name)
            for name, p in points.items()
        ],
        F.sum("_n").alias("linhas"),
        F.sum(F.col("_v") * F.col("_n")).alias("soma"),
    )


PERCENTILES = {"mediana_minutos": 50, "p95_minutos": 95, "p99_minutos": 99}


def duration_stats(df: DataFrame, start: str, end: str) -> DataFrame:
    """Range, mean, median, 95th and 99th percentile of known durations in minutes.

    Exact: whole seconds are counted per value and everything follows from the counts.
    """
    known = df.select(durations.elapsed_seconds(start, end).alias("_seconds"))
    points = {"min_minutos": 0, "max_minutos": 100, **PERCENTILES}
    stats = exact_percentiles(known, "_seconds", points, width=86400)
    return stats.select(
        *[(F.col(name) / F.lit(60.0)).alias(name) for name in points],
        (F.try_divide("soma", "linhas") / F.lit(60.0)).alias("media_minutos"),
    )


def duration_stats_sketch(
    df: DataFrame, start: str, end: str, accuracy: int = 10000
) -> DataFrame:
    """The same figures with percentiles from mergeable summaries, ranks off by at most
    rows / ``accuracy``."""
    value = durations.elapsed(start, end)
    levels = F.percentile_approx(value, [p / 100 for p in PERCENTILES.values()], accuracy)
    return df.agg(
        F.min(value).alias("min_minutos"),
        F.max(value).alias("max_minutos"),
        F.avg(value).alias("media_minutos"),
        levels.alias("_p"),
    ).select(
        "min_minutos", "max_minutos", "media_minutos",
        *[F.get("_p", i).alias(name) for i, name in enumerate(PERCENTILES)],
    )


def duration_stats_hours(df: DataFrame, start: str, end: str) -> DataFrame:
    seconds = durations.elapsed_seconds(start, end)
    return df.agg(
        (F.sum(seconds) / F.count(seconds) / F.lit(3600.0)).alias("media_horas"),
        (F.min(seconds) / F.lit(3600.0)).alias("min_horas"),
        (F.max(seconds) / F.lit(3600.0)).alias("max_horas"),
        F.stddev(seconds / F.lit(3600.0)).alias("desvio_padrao"),
    )


def long_share(df: DataFrame, start: str, end: str, minutes: float = v.LONG_MIN_MINUTES) -> DataFrame:
    """Closed events longer than a limit, as number and share."""
    seconds = durations.elapsed_seconds(start, end)
    counts = df.agg(
        F.count(seconds).alias("com_duracao"),
        F.count_if(seconds > int(minutes * 60)).alias("qtd_longas"),
    )
    return counts.withColumn("pct_longas", text.share(F.col("qtd_longas"), F.col("com_duracao")))


def period_covered(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("inicio"), F.max(column).alias("fim"))


def distinct_members(df: DataFrame, column: Column, approximate: bool = False) -> DataFrame:
    """How many different values occur; sketched when only the size matters."""
    count = F.approx_count_distinct if approximate else F.countDistinct
    return df.agg(count(column).alias("total"))


def count_and_distinct(df: DataFrame, by: str, member: str) -> DataFrame:
    """Rows and different members per value.

    Counted per pair first, so one frequent value is spread over its members.
    """
    pairs = df.groupBy(by, member).agg(F.count(F.lit(1)).alias("_n"))
    return pairs.groupBy(by).agg(
        F.sum("_n").alias("qtd_registros"), F.count(member).alias("qtd_ordens_unicas")
    )


def top_outage_time(df: DataFrame, agent: str, start: str, end: str, k: int = 5) -> DataFrame:
    seconds = durations.elapsed_seconds(start, end)
    totals = df.groupBy(agent).agg(
        F.sum(seconds).alias("_seconds"), F.count(F.lit(1)).alias("qtd_interrupcoes")
    )
    hours = totals.select(
        agent, (F.col("_seconds") / F.lit(3600.0)).alias("total_horas"), "qtd_interrupcoes"
    )
    return top_k(hours, by="total_horas", k=k, ties=[agent])


def cause_analysis(
    df: DataFrame, levels: list[str], start: str, end: str, consumers: str
) -> DataFrame:
    """Events, hours and consumers affected per cause."""
    seconds = durations.elapsed_seconds(start, end)
    return df.groupBy(*levels).agg(
        F.count(F.lit(1)).alias("qtd_eventos"),
        (F.coalesce(F.sum(seconds), F.lit(0)) / F.lit(3600.0)).alias("total_horas"),
        F.sum(consumers).alias("consumidores_afetados"),
    )


def cause_rollup(
    df: DataFrame, levels: list[str], start: str, end: str, consumers: str
) -> DataFrame:
    """Totals of every node of the cause tree, from its leaves to the whole.

    ``nivel`` tells how many levels a row names: 0 is the total. A level that an event lacks
    is null at any ``nivel``, so only that column tells a missing cause from a subtotal. Every
    row is expanded to its path of nodes and reduced in the map tasks, then exchanged once;
    seconds and counts are integers, so each node is exactly the sum of those below it.
    """
    seconds = F.coalesce(durations.elapsed_seconds(start, end), F.lit(0))
    named = len(levels) - F.bit_count("_grouping")
    return df.rollup(*levels).agg(
        F.grouping_id().alias("_grouping"),
        F.count(F.lit(1)).alias("qtd_eventos"),
        F.sum(seconds).alias("total_segundos"),
        F.sum(consumers).alias("consumidores_afetados"),
    ).select(named.cast("int").alias("nivel"), *levels, "qtd_eventos", "total_segundos", "consumidores_afetados")


def top_cause(df: DataFrame, agent: str, cause: str) -> DataFrame:
    """The most frequent cause of each distributor, the first by name among equals."""
    counted = count_by(df.filter(F.col(cause).isNotNull()), agent, cause, name="qtd_eventos")
    first = Window.partitionBy(agent).orderBy(F.desc("qtd_eventos"), F.asc(cause))
    return (
        counted.withColumn("_place", F.row_number().over(first))
        .filter(F.col("_place") == 1)
        .drop("_place")
    )


def conjunto_ranking(df: DataFrame, agent: str, conjunto: str, start: str, end: str) -> DataFrame:
    """Conjuntos of each distributor by total time, longest first.

    The window sees one row per conjunto, the number a distributor operates.
    """
    seconds = durations.elapsed_seconds(start, end)
    totals = df.groupBy(agent, conjunto).agg(
        F.coalesce(F.sum(seconds), F.lit(0)).alias("_seconds"),
        F.count(F.lit(1)).alias("qtd_eventos"),
    )
    longest = Window.partitionBy(agent).orderBy(F.desc("_seconds"))
    return totals.select(
        agent,
        conjunto,
        (F.col("_seconds") / F.lit(3600.0)).alias("total_horas"),
        "qtd_eventos",
        F.rank().over(longest).alias("posicao"),
    )


def consumers_stats(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.avg(column).alias("media"), F.max(column).alias("maximo"))


def quality_summary(
    df: DataFrame,
    critical: list[str],
    keys: list[str],
    consumers: str,
    start: str,
    end: str,
) -> DataFrame:
    """Each known problem with number of rows and share of the table.

    Duplicates are rows beyond the first of a key. All problems come from one
    aggregation by that key.
    """
    seconds = durations.elapsed_seconds(start, end)
    flag = durations.duration_flag(start, end)
    any_null = ~F.lit(True)
    for c in critical:
        any_null = any_null | F.col(c).isNull()
    rules = {
        "campos_nulos_criticos": any_null,
        "duracao_zero": seconds == 0,
        "duracao_7_a_30_dias": flag == v.FLAG_LONG,
        "duracao_mais_30_dias": flag == v.FLAG_EXTREME,
        "uc_zero": F.col(consumers) == 0,
    }
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(rule).alias(name) for name, rule in rules.items()],
    )
    totals = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicatas"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in rules],
    )
    return totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("problema"),
                        F.col(name).alias("quantidade"),
                        text.share(F.col(name), F.col("_rows")).alias("pct"),
                    )
                    for name in [*rules, "duplicatas"]
                ]
            )
        )
    )
