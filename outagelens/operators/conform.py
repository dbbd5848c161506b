"""From source columns to conformed event and indicator tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outagelens import vocabulary as v
from outagelens.functions import calendar, durations, text
from outagelens.operators.names import normalize_names


def _stamp(df: DataFrame, name: str) -> Column:
    """A typed stamp as it is; text is parsed and becomes null when it is no timestamp."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.try_to_timestamp(F.col(name)).cast("timestamp_ntz")
    return F.col(name)


def conform_events(df: DataFrame) -> DataFrame:
    """Business and provenance columns renamed, missing text replaced, minutes derived.

    An event without a start cannot be keyed and is dropped; an open event lasts zero
    minutes. Narrow: a projection and a filter the scan can take.
    """

    def text_or(name: str, default: str) -> Column:
        return F.coalesce(F.col(name), F.lit(default))

    stamped = df.withColumns(
        {c: _stamp(df, c) for c in ("DatInicioInterrupcao", "DatFimInterrupcao")}
    )
    provenance = {
        "_source_url": text_or("_source_url", ""),
        "_source_last_modified": text_or("_source_last_modified", ""),
    }
    carried = [
        provenance.get(c, F.col(c)).alias(c) for c in df.columns if c.startswith("_")
    ]
    return stamped.filter(F.col("DatInicioInterrupcao").isNotNull()).select(
        text_or("SigAgente", v.UNKNOWN_AGENT).alias("cod_distribuidora"),
        F.col("DatInicioInterrupcao").alias("data_inicio"),
        text_or("DscConjuntoUnidadeConsumidora", v.NOT_INFORMED).alias("conjunto"),
        text_or("DscTipoInterrupcao", v.NOT_CLASSIFIED).alias("tipo_interrupcao"),
        F.col("DatFimInterrupcao").alias("data_fim"),
        text_or("DscFatoGeradorInterrupcao", v.NOT_INFORMED).alias("origem_interrupcao"),
        durations.elapsed(
            "DatInicioInterrupcao", "DatFimInterrupcao", "minutes", null_as_zero=True
        ).alias("tempo_interrupcao_minutos"),
        *carried,
    )


def trim_text(df: DataFrame, columns: list[str] | None = None, upper: tuple[str, ...] = ()) -> DataFrame:
    """Trim text columns (all of them by default); those in ``upper`` also in capitals."""
    chosen = columns or [
        f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name[0] != "_"
    ]
    return df.withColumns(
        {c: F.upper(F.trim(c)) if c in upper else F.trim(c) for c in chosen}
    )


def with_cause_levels(df: DataFrame, column: str) -> DataFrame:
    return df.withColumns(
        {name: text.cause_level(F.col(column), i + 1) for i, name in enumerate(v.CAUSE_LEVELS)}
    )


def with_calendar(df: DataFrame, stamp: str) -> DataFrame:
    return df.withColumns(calendar.calendar_fields(stamp))


def with_duration(
    df: DataFrame,
    start: str,
    end: str,
    unit: str = "minutes",
    null_as_zero: bool = False,
    whole_units: bool = False,
    digits: int | None = None,
    name: str | None = None,
) -> DataFrame:
    names = {"seconds": "duracao_segundos", "minutes": "duracao_minutos", "hours": "duracao_horas"}
    return df.withColumn(
        name or names[unit],
        durations.elapsed(start, end, unit, null_as_zero, whole_units, digits),
    )


def with_duration_triplet(df: DataFrame, start: str, end: str) -> DataFrame:
    """Seconds, minutes to 2 and hours to 4 decimals."""
    df = with_duration(df, start, end, "seconds")
    df = with_duration(df, start, end, "minutes", digits=2)
    return with_duration(df, start, end, "hours", digits=4)


def with_duration_class(
    df: DataFrame,
    minutes: str = "duracao_minutos",
    short_max: float = v.SHORT_MAX_MINUTES,
    long_min: float = v.LONG_MIN_MINUTES,
) -> DataFrame:
    return df.withColumn(
        "classe_duracao", durations.duration_class(F.col(minutes), short_max, long_min)
    )


def with_duration_flag(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.withColumn("flag_duracao", durations.duration_flag(start, end))


def with_duration_band(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.withColumn("faixa_duracao", durations.duration_band(start, end))


def with_scheduled_flag(df: DataFrame, kind: str = "DscTipoInterrupcao") -> DataFrame:
    """True for scheduled events; an unknown type counts as not scheduled."""
    return df.withColumn("programada", F.coalesce(F.col(kind) == v.SCHEDULED, F.lit(False)))


def with_cnpj(df: DataFrame, number: str) -> DataFrame:
    return df.withColumn("cnpj_formatado", text.cnpj_text(F.col(number)))


def with_voltage_kv(df: DataFrame, volts: str) -> DataFrame:
    return df.withColumn("nivel_tensao_kv", text.kilovolts(F.col(volts)))


def conform_events_detailed(
    df: DataFrame, run_ts: dt.datetime | None = None, origin: str = ""
) -> DataFrame:
    """The 34-column event table: snake-case names, trimmed text, every derived field.

    Quality filters are separate (``filters.quality_filter``) and belong before this,
    where they still reach the scan.
    """
    source = df.select(*[c for c in df.columns if not c.startswith("_")])
    silver = trim_text(normalize_names(source, "snake"))
    silver = silver.withColumnRenamed("num_cpfcnpj", "num_cnpj")
    start, end = "dat_inicio_interrupcao", "dat_fim_interrupcao"
    silver = with_cause_levels(silver, "dsc_fato_gerador_interrupcao")
    silver = with_calendar(with_duration_triplet(silver, start, end), start)
    silver = with_voltage_kv(with_cnpj(silver, "num_cnpj"), "num_nivel_tensao")
    if run_ts is None:
        return silver
    return silver.withColumns(
        {
            "_silver_ts": F.lit(run_ts),
            "_silver_run_id": F.lit(run_ts.strftime("%Y%m%d%H%M%S")),
            "_origem_tabela": F.lit(origin),
        }
    )


def conform_indicators_long(
    df: DataFrame, run_ts: dt.datetime | None = None, version: str = "v1.0.0"
) -> DataFrame:
    """One row per conjunto, agent, month and indicator, with trimmed text and a month date.

    Columns whose sources the table lacks are left out.
    """
    columns = {
        "id_conjunto_uc": (F.col, "ideconjundconsumidoras"),
        "conjunto_uc": (F.trim, "dscconjundconsumidoras"),
        "distribuidora": (F.trim, "sigagente"),
        "cnpj": (F.col, "numcnpj"),
        "indicador": (F.trim, "sigindicador"),
        "valor": (F.col, "vlrindiceenviado"),
        "data_apuracao": (calendar.month_start, "anoindice", "numperiodoindice"),
        "ano": (F.col, "anoindice"),
        "mes": (F.col, "numperiodoindice"),
        "data_geracao_fonte": (F.col, "datgeracaoconjuntodados"),
        "fonte_url": (F.col, "_fonte_url"),
        "ingest_ts_bronze": (F.col, "_ingest_ts"),
        "ingest_date_bronze": (F.col, "_ingest_date"),
        "run_id_bronze": (F.col, "_run_id"),
        "_tie": (F.col, "_tie"),
    }
    silver = df.select(*[
        make(*(F.col(s) if len(sources) > 1 else s for s in sources)).alias(name)
        for name, (make, *sources) in columns.items()
        if set(sources) <= set(df.columns)
    ])
    if run_ts is None:
        return silver
    return silver.withColumns(
        {
            "_processado_em": F.lit(run_ts),
            "_data_processamento": F.lit(run_ts.date()),
            "_versao_silver": F.lit(version),
            "_run_id_silver": F.lit(run_ts.strftime("%Y%m%d%H%M%S")),
        }
    )


def enrich_region(df: DataFrame, mapping: DataFrame, agent: str) -> DataFrame:
    """Attach mapping columns by agent; agents the mapping lacks keep null.

    ``mapping`` has a column ``agente``, unique. No broadcast hint: the optimizer
    broadcasts it while its measured size is under the threshold and shuffles otherwise.
    """
    return df.join(
        mapping.withColumnRenamed("agente", "_map_agent"),
        F.col(agent) == F.col("_map_agent"),
        "left",
    ).drop("_map_agent")
