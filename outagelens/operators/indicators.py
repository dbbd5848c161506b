"""Indicator series: wide tables, monthly figures per distributor, and reports on them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outagelens import vocabulary as v
from outagelens.functions import calendar, text
from outagelens.operators.dedupe import latest_per_key
from outagelens.operators.ranking import top_k

# silver long key: one value per conjunto, agent, month and indicator
CONJUNTO_MONTH = ["distribuidora", "id_conjunto_uc", "ano", "mes"]
CELL_KEY = [*CONJUNTO_MONTH, "indicador"]


def latest_cells(silver: DataFrame, order: list[str], ties: list[str] | None = None) -> DataFrame:
    """The newest value of every cell of the silver long table, still long."""
    return latest_per_key(silver, CELL_KEY, order, ties)


def latest_wide(
    df: DataFrame,
    keys: list[str],
    code: str,
    value: str,
    codes: list[str],
    order: list[str],
    described: list[str] | None = None,
    every_code: bool = False,
) -> DataFrame:
    """Long rows to one row per key with a column per code, each its newest value.

    Deduplication and pivot in one aggregation: a cell keeps the value of its greatest
    ``order``, so superseded rows are dropped by the map-side partials and one exchange
    does for both. The codes are given, so no job looks for them, and other codes are
    filtered at the scan; with ``every_code`` keys that have only other codes stay, with
    nulls. ``described`` columns come from the newest row of the key.
    """
    newest = [
        F.max(F.when(F.col(code) == name, F.struct(*order, value))).getField(value).alias(
            name.lower()
        )
        for name in codes
    ]
    extra = []
    if described:
        row = F.max(F.struct(*order, F.struct(*described).alias("_row")))
        extra = [row.getField("_row").alias("_newest")]
    rows = df if every_code else df.filter(F.col(code).isin(codes))
    # the hash first: rows are sorted by a number and not by agents that mostly begin alike
    wide = rows.groupBy(F.xxhash64(*keys).alias("_hash"), *keys).agg(*newest, *extra)
    names = [name.lower() for name in codes]
    return wide.select(*keys, *(["_newest.*"] if described else []), *names)


def conjunto_month(
    silver: DataFrame, order: list[str], codes: list[str], every_code: bool = False
) -> DataFrame:
    """The silver long table as one row per conjunto and month, newest values.

    With ``every_code`` a conjunto that reported only other codes has its row too.
    """
    return latest_wide(silver, CONJUNTO_MONTH, "indicador", "valor", codes, order, every_code=every_code)


def indicators_wide(
    df: DataFrame,
    order: list[str],
    values: list[str] = v.INDICATOR_CODES,
    keys: list[str] = v.INDICATOR_KEY,
    legacy_columns: bool = False,
    run_ts: dt.datetime | None = None,
) -> DataFrame:
    """Bronze long series to the wide silver table.

    ``legacy_columns`` gives it its documented shape, in which the conjunto id and the
    period are not visible and the period date is the first of January.
    """
    described = ["dscconjundconsumidoras", "numcnpj", "_fonte_url", "_ingest_ts"]
    wide = latest_wide(
        df, keys, "sigindicador", "vlrindiceenviado", values, order, described
    )
    year, month = F.col("anoindice"), F.col("numperiodoindice")
    named = wide.withColumns(
        {
            "codigo_distribuidora": F.upper(F.trim("sigagente")),
            "distribuidora": F.trim("dscconjundconsumidoras"),
            "ano_referencia": year,
            "periodo_apuracao": (
                calendar.year_start(year) if legacy_columns else calendar.month_start(year, month)
            ),
        }
    ).withColumn("chave_uc", F.coalesce(F.col("sigagente"), F.col("distribuidora")))
    if run_ts is not None:
        named = named.withColumn("_timestamp_transformacao", F.lit(run_ts))
    if legacy_columns:
        named = named.drop("ideconjundconsumidoras", "numcnpj", "numperiodoindice")
    return named


def wide_keys_text(wide: DataFrame) -> DataFrame:
    """The documented composite key: agent, conjunto and year in one text."""
    return wide.withColumn(
        "chave_composta",
        text.composite_key(
            F.trim("sigagente"), F.trim("dscconjundconsumidoras"), F.col("anoindice")
        ),
    )


def conflicting_cells(df: DataFrame) -> DataFrame:
    """Keys whose rows carry more than one registration number."""
    return (
        df.groupBy(*v.INDICATOR_KEY)
        .agg(F.min("numcnpj").alias("menor_cnpj"), F.max("numcnpj").alias("maior_cnpj"))
        .filter(F.col("menor_cnpj") != F.col("maior_cnpj"))
    )


def _only(indicator: str) -> Column:
    return F.when(F.col("indicador") == indicator, F.col("valor"))


GOLD_CODES = ["DEC", "DECIND", "DECINC", "FEC", "NumCon"]


def gold_indicator_month(
    conjuntos: DataFrame, strict_month: bool = False, run_ts: dt.datetime | None = None
) -> DataFrame:
    """Monthly figures per distributor with the previous month, its change and a rank.

    ``conjuntos`` has one row per conjunto and month with ``GOLD_CODES`` as columns. The
    previous value is that of the row before; with ``strict_month`` it is null unless
    that row is the month before. Rank 1 is the highest mean DEC of the month.

    The windows see aggregated rows only: per distributor as many as there are months,
    per month as many as there are distributors.
    """
    monthly = conjuntos.groupBy("distribuidora", "ano", "mes").agg(
        F.avg("dec").alias("dec_medio"),
        F.min("dec").alias("dec_minimo"),
        F.max("dec").alias("dec_maximo"),
        F.sum("dec").alias("dec_total"),
        F.avg("decind").alias("decind_medio"),
        F.sum("decind").alias("decind_total"),
        F.avg("decinc").alias("decinc_medio"),
        F.sum("decinc").alias("decinc_total"),
        F.avg("fec").alias("fec_medio"),
        F.sum("fec").alias("fec_total"),
        F.avg("numcon").alias("numcon_medio"),
        F.sum("numcon").alias("numcon_total"),
        F.count(F.lit(1)).alias("qtd_conjuntos"),
    )
    by_agent = Window.partitionBy("distribuidora").orderBy("ano", "mes")
    by_month = Window.partitionBy("ano", "mes").orderBy(F.col("dec_medio").desc_nulls_last())
    previous = F.lag("dec_medio").over(by_agent)
    if strict_month:
        number = calendar.month_number(F.col("ano"), F.col("mes"))
        previous = F.when(number - F.lag(number).over(by_agent) == 1, previous)
    dated = monthly.withColumns(
        {
            "sigagente": F.col("distribuidora"),
            "codigo_distribuidora": F.col("distribuidora"),
            "ano_mes": calendar.month_start(F.col("ano"), F.col("mes")),
            "dec_medio_mes_anterior": previous,
        }
    )
    gold = dated.withColumns(
        {
            "variacao_perc_mes_anterior": F.try_divide(
                F.col("dec_medio") - F.col("dec_medio_mes_anterior"),
                F.col("dec_medio_mes_anterior"),
            )
            * F.lit(100.0),
            "ranking_dec_mes": F.rank().over(by_month),
        }
    )
    return gold if run_ts is None else gold.withColumn("timestamp_processamento", F.lit(run_ts))


def dec_fec_evolution(
    silver: DataFrame, year: int, min_consumers: float = 100000, k: int = 50
) -> DataFrame:
    """Largest DEC, FEC and consumers reported per distributor and month of a year."""
    monthly = (
        silver.filter(F.col("indicador").isin("DEC", "FEC", "NumCon") & (F.col("ano") == year))
        .groupBy("distribuidora", "data_apuracao", "ano", "mes")
        .agg(
            F.max(_only("DEC")).alias("dec_horas"),
            F.max(_only("FEC")).alias("fec_qtd"),
            F.max(_only("NumCon")).alias("num_consumidores"),
        )
        .filter(F.col("num_consumidores") > min_consumers)
    )
    return (
        monthly.select(
            "distribuidora",
            "data_apuracao",
            "dec_horas",
            "fec_qtd",
            "num_consumidores",
            F.round(F.col("dec_horas") * F.col("num_consumidores"), 2).alias("dec_total_horas"),
        )
        .orderBy("distribuidora", "data_apuracao")
        .limit(k)
    )


def indicators_slice(
    silver: DataFrame, indicators: list[str], since: dt.date, month: int | None = None
) -> DataFrame:
    rows = silver.filter(
        F.col("indicador").isin(indicators) & (F.col("data_apuracao") >= F.lit(since))
    )
    return rows if month is None else rows.filter(F.col("mes") == month)


def value_stats(
    df: DataFrame, by: str, value: str, spread: bool = False, k: int = 10
) -> DataFrame:
    """Mean with either range or standard deviation per indicator, most frequent first."""
    measures = (
        [F.stddev(value).alias("desvio_padrao")]
        if spread
        else [F.min(value).alias("minimo"), F.max(value).alias("maximo")]
    )
    stats = df.groupBy(by).agg(
        F.avg(value).alias("media"), *measures, F.count(F.lit(1)).alias("quantidade")
    )
    return top_k(stats, by="quantidade", k=k, ties=[by])


def top_mean_dec(silver: DataFrame, k: int = 5) -> DataFrame:
    means = (
        silver.filter(F.col("indicador") == "DEC")
        .groupBy("distribuidora")
        .agg(F.avg("valor").alias("dec_medio"), F.count(F.lit(1)).alias("qtd_medicoes"))
    )
    return top_k(means, by="dec_medio", k=k, ties=["distribuidora"])


def top_dec_year(gold: DataFrame, year: int, k: int = 5) -> DataFrame:
    means = (
        gold.filter(F.col("ano") == year)
        .groupBy("distribuidora")
        .agg(
            F.avg("dec_medio").alias("dec_medio_anual"),
            F.sum("numcon_total").alias("total_consumidores"),
            F.count(F.lit(1)).alias("meses_registrados"),
        )
    )
    return top_k(means, by="dec_medio_anual", k=k, ties=["distribuidora"])


def gold_overall(gold: DataFrame) -> DataFrame:
    return gold.agg(
        F.avg("dec_medio").alias("media_dec_medio"),
        F.avg("fec_medio").alias("media_fec_medio"),
        F.avg("numcon_total").alias("media_consumidores"),
    )


def variation_stats(gold: DataFrame) -> DataFrame:
    """Distribution of the month-on-month change, where there is one."""
    change = "variacao_perc_mes_anterior"
    return gold.filter(F.col(change).isNotNull()).agg(
        F.avg(change).alias("variacao_media"),
        F.stddev(change).alias("desvio_padrao"),
        F.min(change).alias("min_variacao"),
        F.max(change).alias("max_variacao"),
    )


def coverage(silver: DataFrame) -> DataFrame:
    """First and last month and how many periods, years and months occur.

    The table is reduced to its distinct months by map-side partials first; counting
    three things distinct directly would send every row three times.
    """
    periods = silver.select("data_apuracao", "ano", "mes").distinct()
    return periods.agg(
        F.min("data_apuracao").alias("data_inicio"),
        F.max("data_apuracao").alias("data_fim"),
        F.countDistinct("data_apuracao").alias("total_periodos"),
        F.countDistinct("ano").alias("total_anos"),
        F.countDistinct("mes").alias("total_meses"),
    )


def indicator_distribution(silver: DataFrame) -> DataFrame:
    """Rows, distributors and share per indicator.

    Counted per indicator and distributor first; the total is a window over the
    indicator totals, as many rows as there are codes.
    """
    per_pair = silver.groupBy("indicador", "distribuidora").agg(F.count(F.lit(1)).alias("_n"))
    per_code = per_pair.groupBy("indicador").agg(
        F.sum("_n").alias("total_registros"),
        F.count("distribuidora").alias("total_distribuidoras"),
    )
    everything = F.sum("total_registros").over(Window.partitionBy())
    return per_code.withColumn("percentual", text.share(F.col("total_registros"), everything))


def top_volume(silver: DataFrame, k: int = 10) -> DataFrame:
    """Distributors with most rows, the indicators they report and the period covered."""
    per_pair = silver.groupBy("distribuidora", "indicador").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("data_apuracao").alias("_first"),
        F.max("data_apuracao").alias("_last"),
    )
    volume = per_pair.groupBy("distribuidora").agg(
        F.sum("_n").alias("total_registros"),
        F.count("indicador").alias("indicadores_reportados"),
        F.min("_first").alias("primeira_data"),
        F.max("_last").alias("ultima_data"),
    )
    return top_k(volume, by="total_registros", k=k, ties=["distribuidora"])


def mean_dec_by_year(wide: DataFrame) -> DataFrame:
    """Mean DEC per distributor and year from the wide table."""
    return wide.groupBy("codigo_distribuidora", "ano_referencia").agg(
        F.avg("dec").alias("dec_medio"), F.count("dec").alias("medicoes")
    )


def annual_means(conjuntos: DataFrame) -> DataFrame:
    """Mean DEC and FEC per distributor and year from conjunto months."""
    return conjuntos.groupBy("distribuidora", "ano").agg(
        F.avg("dec").alias("dec_medio"), F.avg("fec").alias("fec_medio")
    )


def month_jumps(gold: DataFrame, min_percent: float) -> DataFrame:
    """Months in which mean DEC rose by more than a percentage of the month before."""
    return gold.filter(F.col("variacao_perc_mes_anterior") > min_percent).select(
        "distribuidora", "ano", "mes", "dec_medio", "dec_medio_mes_anterior",
        "variacao_perc_mes_anterior",
    )


def _median(values: Column) -> Column:
    """Of an array without nulls; null if it is empty."""
    ranked, half = F.array_sort(values), F.size(values) / 2
    lower, upper = F.get(ranked, F.ceil(half).cast("int") - 1), F.get(ranked, F.floor(half).cast("int"))
    return (lower + upper) / 2


def robust_jumps(gold: DataFrame, months: int = 12, min_history: int = 6, threshold: float = 3.5) -> DataFrame:
    """Months whose mean DEC lies far above what the ``months`` before it were.

    The baseline is the median of the months on record among them, counted by the calendar,
    so a gap in the series makes the history shorter and not older; ``desvios`` is the
    distance in median absolute deviations, scaled as standard deviations are. A history in
    which more than half the months are equal has no spread: any rise above it counts, and
    desvios is null. Months with fewer than ``min_history`` values before them are not judged.

    The window runs over monthly rows, of which a distributor has as many as there are months
    on record, and holds ``months`` values of them at a time.
    """
    number = calendar.month_number(F.col("ano"), F.col("mes"))
    past = Window.partitionBy("distribuidora").orderBy("_m").rangeBetween(-months, -1)
    seen = gold.select("distribuidora", "ano", "mes", "dec_medio", number.alias("_m")).withColumn(
        "_past", F.collect_list("dec_medio").over(past))
    based = seen.withColumn("mediana", _median(F.col("_past")))
    spread = based.withColumn("mad", _median(F.transform("_past", lambda x: F.abs(x - F.col("mediana")))))
    rise = F.col("dec_medio") - F.col("mediana")
    judged = spread.withColumn("desvios", F.when(F.col("mad") > 0, rise / (F.col("mad") * F.lit(1.4826))))
    sudden = F.when(F.col("mad") > 0, F.col("desvios") > threshold).otherwise(rise > 0)
    return judged.filter((F.size("_past") >= min_history) & sudden).select(
        "distribuidora", "ano", "mes", "dec_medio", F.size("_past").cast("bigint").alias("historico"),
        "mediana", "mad", "desvios")


def month_rank(gold: DataFrame, places: int = 3) -> DataFrame:
    """The worst distributors of each month."""
    return gold.filter(F.col("ranking_dec_mes") <= places).select(
        "ano", "mes", "ranking_dec_mes", "distribuidora", "dec_medio"
    )
