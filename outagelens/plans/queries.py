"""Every operator as a query over the test tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each asks the stand-in views only for the columns it uses, so scans stay narrow and
unused lookups are not joined.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outagelens import vocabulary as v
from outagelens.functions import durations
from outagelens.operators import (
    compare, conform, dedupe, filters, indicators, names, outages, profiling, quality, ranking,
    sketches,
)
from outagelens.session import pin_utc, table_path
from outagelens.plans import medallion
from outagelens.sources import ledger, metrics, readers, standins, tables

REGISTRY: dict = {}

START, END = "DatInicioInterrupcao", "DatFimInterrupcao"
ROW = ["NumOrdemInterrupcao", "_tie"]
YEAR, YEARS = 1998, [1997, 1998]
RUN = dt.datetime(2024, 1, 2, 6, 0, tzinfo=dt.timezone.utc)
EVENT_COLUMNS = [line.split()[0] for line in v.EVENT_SCHEMA.strip().splitlines()]
ORDER_NUMBER = (["NumOrdemInterrupcao"], ["DatGeracaoConjuntoDados", END, "_tie"])
NATURAL_ORDER = ["_ingest_timestamp", "DatGeracaoConjuntoDados", "data_fim", "_tie"]


def query(build):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(pin_utc(spark), sf_dir)

    REGISTRY[build.__name__] = run
    return build


# ---- shared stages ----------------------------------------------------------


def _silver_events(spark, sf):
    """Conformed events before deduplication, with what the total order needs."""
    wanted = [
        "SigAgente", START, "DscConjuntoUnidadeConsumidora", "DscTipoInterrupcao", END,
        "DscFatoGeradorInterrupcao", "_ingest_timestamp", "_source_url",
        "_source_last_modified", "_ano_fonte", "_tie",
    ]
    bronze = standins.events(spark, sf, *wanted, "DatGeracaoConjuntoDados")
    conformed = conform.conform_events(bronze.withColumnRenamed("DatGeracaoConjuntoDados", "_generated"))
    return conformed.withColumnRenamed("_generated", "DatGeracaoConjuntoDados")


def _valid_latest(spark, sf, *extra):
    """The newest row per order number, if it is temporally valid.

    An invalid newest row takes its event out; it does not bring back the row it replaced.
    """
    wanted = dict.fromkeys([*ORDER_NUMBER[0], *ORDER_NUMBER[1], START, *extra])
    newest = dedupe.latest_per_key(standins.events(spark, sf, *wanted), *ORDER_NUMBER, ties=[])
    return filters.temporal_valid(newest)


def _gold_outages(spark, sf, **options):
    kept = conform.with_duration(
        _valid_latest(spark, sf, "SigAgente"), START, END, null_as_zero=True
    )
    return outages.gold_outage_month(kept, "SigAgente", START, "duracao_minutos", **options)


def _silver_long(spark, sf):
    return conform.conform_indicators_long(standins.indicators(spark, sf))


def _silver_measures(spark, sf):
    """The long silver table without what only the ingestion knows, so without its join."""
    wanted = [
        "ideconjundconsumidoras", "dscconjundconsumidoras", "sigagente", "numcnpj", "sigindicador",
        "vlrindiceenviado", "anoindice", "numperiodoindice", "_fonte_url", "_tie",
    ]
    return conform.conform_indicators_long(standins.indicators(spark, sf, *wanted))


def _conjuntos(spark, sf, codes, every_code=False):
    return indicators.conjunto_month(
        _silver_long(spark, sf), ["ingest_ts_bronze", "_tie"], codes, every_code
    )


def _gold_indicators(spark, sf, **options):
    conjuntos = _conjuntos(spark, sf, indicators.GOLD_CODES, every_code=True)
    return indicators.gold_indicator_month(conjuntos, **options)


def _wide(spark, sf, **options):
    return indicators.indicators_wide(
        standins.indicators(spark, sf), ["_ingest_ts", "_tie"], **options
    )


def _index_events(spark, sf):
    """Events that count towards the index: quality rules, not scheduled, minimum size."""
    bronze = standins.events(
        spark, sf, "SigAgente", START, END, "NumUnidadeConsumidora", "NumNivelTensao",
        "IdeConjuntoUnidadeConsumidora", "NumConsumidorConjunto", "DscTipoInterrupcao",
    )
    return filters.dec_event_filter(
        filters.quality_filter(bronze), exclude=v.TYPES_EXCLUDED
    )


def _observed(spark, sf):
    return compare.observed_month(_index_events(spark, sf))


def _official(spark, sf):
    return compare.official_month(_conjuntos(spark, sf, compare.INDEX_CODES))


# ---- scans and sources ------------------------------------------------------


@query
def scan_events(spark, sf):
    return standins.events(spark, sf, *EVENT_COLUMNS)


@query
def scan_year_in(spark, sf):
    standins.indicators(spark, sf).createOrReplaceTempView("outagelens_indicators")
    rows = readers.read_year_list(spark, "outagelens_indicators", "anoindice", YEARS)
    return rows.select(*v.INDICATOR_KEY, "sigindicador", "vlrindiceenviado")


@query
def scan_indicators_stored(spark, sf):
    path = table_path(spark, "bronze_indicators")
    wanted = [line.split()[0] for line in v.INDICATOR_SCHEMA.strip().splitlines()]
    tables.replace_all(standins.indicators(spark, sf, *wanted), path, "anoindice")
    return readers.read_indicators(spark, path, YEARS).select(*wanted)


@query
def scan_year_partition(spark, sf):
    path = table_path(spark, "bronze_events")
    wanted = [*ROW, START, "NumUnidadeConsumidora", "_ano_fonte"]
    tables.replace_all(standins.events(spark, sf, *wanted), path, "_ano_fonte")
    stored = readers.read_events(spark, path, YEARS, ", _tie DOUBLE, _ano_fonte INT")
    return stored.select(*wanted)


@query
def scan_by_name(spark, sf):
    """A stored table read by its catalog name, and one that is not there skipped."""
    path = table_path(spark, "by_name")
    name = f"outagelens_{path.rpartition('-')[2]}"
    rows = standins.events(spark, sf, *ROW, "NumUnidadeConsumidora", "_ano_fonte")
    tables.replace_all(rows, path, "_ano_fonte")
    tables.publish(spark, path, name, rows.schema)
    found, status = readers.table_or_skip(spark, name)
    missing, skipped = readers.table_or_skip(spark, f"{name}_none")
    spark.sql(f"DROP TABLE {name}")  # the name only: the files stay, and this plan reads them
    return found.select(*ROW, "NumUnidadeConsumidora", "_ano_fonte").withColumns({
        "situacao": F.lit(status), "ausente": F.lit(missing is None and skipped.startswith("SKIPPED"))})


@query
def scan_csv_landing(spark, sf):
    path = table_path(spark, "landing_csv")
    (
        standins.events(spark, sf, *EVENT_COLUMNS)
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")
        .options(**readers.TEXT_FILES)
        .csv(path)
    )
    return readers.read_csv_landing(spark, path, v.EVENT_SCHEMA)


@query
def csv_quarantine(spark, sf):
    """A landing with planted faults: a text for a number, no date, a field too few, one too many."""
    path = table_path(spark, "landing_csv")
    order, key = F.col("NumOrdemInterrupcao"), F.substring_index("NumOrdemInterrupcao", "-", 1).cast("bigint")
    events = standins.events(spark, sf, *EVENT_COLUMNS)
    values = {c: F.when((key % 53 == 0) & F.lit(c == "NumNivelTensao"), "alta").when(
        (key % 59 == 0) & F.lit(c in (START, "NumNivelTensao")), "ontem").otherwise(
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss") if c in (START, END) else F.col(c).cast("string")) for c in EVENT_COLUMNS}
    line = F.to_csv(F.struct(*[x.alias(c) for c, x in values.items()]),
                    {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    line = F.when(key % 61 == 0, F.concat(line, F.lit(",a mais"))).when(key % 67 == 0, F.concat(order, F.lit(",so isto"))).otherwise(line)
    events.select(line.alias("value")).write.options(**readers.TEXT_FILES).text(path)
    rows = readers.judged(readers.read_csv_checked(spark, path, v.EVENT_SCHEMA, header=False), v.EVENT_SCHEMA)
    fits = F.col("motivo").isNull()
    return rows.select(
        F.coalesce("motivo", F.lit("aceita")).alias("motivo"),
        F.when(fits, order).otherwise(F.regexp_extract(readers.RAW_LINE, r"(^|,)(\d+-\d)(,|$)", 2)).alias("NumOrdemInterrupcao"),
        F.when(fits, F.col("NumUnidadeConsumidora")).alias("NumUnidadeConsumidora"))


@query
def merge_schema_widened(spark, sf):
    """Three deliveries: narrow types and text for a number, wide types, a column that is missing."""
    path = table_path(spark, "deliveries")
    rows = standins.events(spark, sf, *ROW, "NumAno", START, "NumUnidadeConsumidora", "NumNivelTensao")
    tension = F.when(F.col("NumNivelTensao") == 0, "n/d").otherwise(F.col("NumNivelTensao").cast("string"))
    year = F.col("NumAno")
    rows.filter(year < 1997).withColumns({
        "NumUnidadeConsumidora": F.col("NumUnidadeConsumidora").cast("int"), START: F.to_date(START), "NumNivelTensao": tension,
    }).write.parquet(f"{path}/a")
    rows.filter((year >= 1997) & (year < 2000)).write.parquet(f"{path}/b")
    rows.filter(year >= 2000).drop("NumNivelTensao").write.parquet(f"{path}/c")
    return readers.read_reconciled(spark, [f"{path}/{d}" for d in "abc"], {"NumNivelTensao": "bigint"})


# ---- sinks, provenance, ledger ----------------------------------------------


@query
def replace_year_idempotent(spark, sf):
    """All years written, then one year replaced twice over: nothing doubles or vanishes."""
    path = table_path(spark, "silver_events")
    rows = standins.events(spark, sf, *ROW, "NumUnidadeConsumidora", "_ano_fonte")
    tables.replace_all(rows, path, "_ano_fonte")
    for _ in range(2):
        tables.replace_years(rows, path, "_ano_fonte", [YEAR])
    stored = readers.read_events(spark, path, extra=", _tie DOUBLE, _ano_fonte INT")
    return stored.groupBy("_ano_fonte").agg(
        F.count(F.lit(1)).alias("linhas"),
        F.countDistinct("NumOrdemInterrupcao").alias("ordens"),
        F.sum("NumUnidadeConsumidora").alias("unidades"),
    )


@query
def run_summary(spark, sf):
    """Both flows taken through all layers, then what their stages recorded while they wrote."""
    at = {n: table_path(spark, n) for n in (
        "landing", "bronze", "silver", "gold", "ledger", "metrics", "series", "b_series", "s_series", "g_series", "wide")}
    landed = [r["ano"] for r in standins.manifest(spark, sf).select("ano").collect()]
    years = list(range(min(landed), max(landed) + 2))
    standins.events(spark, sf, *EVENT_COLUMNS, "_ano_fonte").withColumnRenamed("_ano_fonte", "_y").write.partitionBy("_y").parquet(at["landing"])
    manifest = standins.manifest(spark, sf).withColumn("url", F.concat(F.lit(f"{at['landing']}/_y="), "ano"))
    medallion.ingest_events(spark, manifest, at["bronze"], at["ledger"], RUN, at["metrics"])
    for n, chosen in enumerate((years[:4], years[4:])):
        medallion.silver_events(spark, at["bronze"], at["silver"], chosen, RUN + dt.timedelta(hours=n), at["metrics"])
    medallion.gold_outages(spark, at["silver"], at["gold"], years, RUN, metrics_path=at["metrics"])

    wanted = [line.split()[0] for line in v.INDICATOR_SCHEMA.strip().splitlines()]
    standins.indicators(spark, sf, *wanted).write.parquet(at["series"])
    medallion.ingest_indicators(spark, at["series"], at["b_series"], years, RUN, at["metrics"])
    extra = ", _fonte_url STRING, _ingest_ts TIMESTAMP, _ingest_date DATE, _run_id STRING"
    bronze = readers.read_indicators(spark, at["b_series"], years, extra)
    medallion.indicator_tables(spark, bronze, at["s_series"], at["g_series"], RUN, at["metrics"], placed=True)
    medallion.wide_indicators(spark, bronze, at["wide"], years, RUN, at["metrics"])
    return metrics.run_summary(metrics.read_metrics(spark, at["metrics"])).drop("ultima_execucao")


@query
def write_match_check(spark, sf):
    rows = standins.events(spark, sf, *ROW, START, END, "_ano_fonte")
    return tables.write_checked(rows, table_path(spark, "checked"), "_ano_fonte")


@query
def merge_schema_union(spark, sf):
    """Older rows lack the voltage column, newer ones the type."""
    rows = standins.events(
        spark, sf, *ROW, "NumAno", "NumNivelTensao", "DscTipoInterrupcao"
    )
    old = rows.filter(F.col("NumAno") < YEAR).drop("NumNivelTensao")
    new = rows.filter(F.col("NumAno") >= YEAR).drop("DscTipoInterrupcao")
    return readers.union_evolving(old, new)


@query
def merge_schema_read(spark, sf):
    """The same evolution in stored files, read back as one table."""
    path = table_path(spark, "evolving")
    rows = standins.events(
        spark, sf, *ROW, "NumAno", "NumNivelTensao", "DscTipoInterrupcao"
    )
    rows.filter(F.col("NumAno") < YEAR).drop("NumNivelTensao").write.parquet(path)
    rows.filter(F.col("NumAno") >= YEAR).drop("DscTipoInterrupcao").write.mode("append").parquet(path)
    return readers.read_evolving(spark, path).select(*rows.columns)


@query
def bronze_provenance(spark, sf):
    stamped = readers.stamp(
        standins.events(spark, sf, *ROW, START), "source", "landing/events.parquet", RUN,
        last_modified="2024-01-01", year=2024,
    )
    return stamped.withColumn("_ingest_date", F.to_date("_ingest_timestamp")).drop("_ingest_timestamp")


@query
def bronze_provenance_run(spark, sf):
    rows = standins.indicators(spark, sf, "sigagente", "sigindicador", "vlrindiceenviado", "_tie")
    return readers.stamp(rows, "run", "landing/indicators.parquet", RUN).drop("_ingest_ts")


@query
def bronze_provenance_file(spark, sf):
    stamped = readers.stamp(
        standins.events(spark, sf, *ROW), "file", "landing/events.parquet", RUN, year=2024
    )
    return stamped.drop("_data_ingestao")


@query
def ledger_entries(spark, sf):
    """Rows landed per year, one year unreadable."""
    loaded = (
        standins.events(spark, sf, "_ano_fonte")
        .groupBy(F.col("_ano_fonte").alias("ano"))
        .agg(F.count(F.lit(1)).alias("num_registros"))
        .select(
            F.lit("interrupcoes").alias("fonte"), "ano", "num_registros",
            F.format_string("landing/events_%d.parquet", "ano").alias("url"),
            F.when(F.col("ano") == YEAR, "arquivo ilegivel").alias("erro"),
        )
    )
    landed = standins.manifest(spark, sf).drop("num_registros")
    return ledger.ledger_entries(landed, loaded, RUN).drop("timestamp_ingestao")


@query
def ledger_pending(spark, sf):
    return ledger.pending(
        standins.manifest(spark, sf), standins.ledger(spark, sf), by_version=False
    )


@query
def ledger_pending_version(spark, sf):
    return ledger.pending(standins.manifest(spark, sf), standins.ledger(spark, sf))


@query
def ledger_pending_files(spark, sf):
    """A year landed as two files of one stamp: each half is pending for itself."""
    return ledger.pending(
        standins.manifest(spark, sf, halves=True), standins.ledger(spark, sf, halves=True)
    ).drop("num_registros")


@query
def ingest_files(spark, sf):
    """Two landed files a year, one of them missing: what the ledger and bronze hold after."""
    landing, bronze, book = (table_path(spark, n) for n in ("landing", "bronze_files", "ledger"))
    half = standins.half_of_year("DatGeracaoConjuntoDados")
    (
        standins.events(spark, sf, *EVENT_COLUMNS, "_ano_fonte").withColumn("metade", half)
        .filter((F.col("_ano_fonte") != YEAR) | (F.col("metade") != 2))
        .withColumns({"_year": F.col("_ano_fonte"), "_half": F.col("metade")}).drop("_ano_fonte", "metade")
        .write.partitionBy("_year", "_half").parquet(landing)
    )
    listed = standins.manifest(spark, sf, halves=True)
    year, half = F.regexp_extract("url", r"events_(\d+)_", 1), F.regexp_extract("url", r"_(\d)\.", 1)
    manifest = listed.withColumn("url", F.concat(F.lit(f"{landing}/_year="), year, F.lit("/_half="), half))
    for _ in range(2):  # the second run tries the missing file only
        medallion.ingest_events(spark, manifest, bronze, book, RUN)
    half_of = F.regexp_extract("url", r"_half=(\d)", 1).cast("int").alias("metade")
    entries = ledger.read_ledger(spark, book)
    stored = readers.read_events(spark, bronze, extra=medallion.BRONZE_EXTRA)
    in_bronze = stored.groupBy(F.col("_source_url").alias("url")).agg(F.count(F.lit(1)).alias("linhas_bronze"))
    waiting = ledger.pending(manifest, entries).select("url", F.lit(True).alias("pendente"))
    return (
        entries.groupBy("fonte", "ano", "url", "status").agg(
            F.count(F.lit(1)).alias("tentativas"), F.sum("num_registros").alias("num_registros"))
        .join(in_bronze, "url", "left").join(waiting, "url", "left")
        .select("fonte", "ano", half_of, "status", "tentativas", "num_registros",
                F.coalesce("linhas_bronze", F.lit(0)).alias("linhas_bronze"),
                F.coalesce("pendente", F.lit(False)).alias("pendente"))
    )


@query
def ledger_summary(spark, sf):
    summary = ledger.ledger_summary(standins.ledger(spark, sf))
    return summary.withColumn("ultima_ingestao", F.col("ultima_ingestao").cast("timestamp_ntz"))


@query
def sample_n(spark, sf):
    rows = standins.events(spark, sf, *ROW, "SigAgente", START, END, "DscTipoInterrupcao")
    return ranking.sample_n(rows, ROW, 10)


# ---- derivations ------------------------------------------------------------


@query
def conform_events(spark, sf):
    return _silver_events(spark, sf).drop("DatGeracaoConjuntoDados")


@query
def conform_events_detailed(spark, sf):
    bronze = standins.events(spark, sf, *EVENT_COLUMNS)
    return conform.conform_events_detailed(filters.quality_filter(bronze))


@query
def conform_indicators_stamped(spark, sf):
    """What a run adds to every row it conforms: its stamp, day, version and number."""
    rows = standins.indicators(spark, sf, "sigagente", "sigindicador", "vlrindiceenviado", "_tie")
    stamped = conform.conform_indicators_long(rows, RUN)
    return stamped.withColumn("_processado_em", F.col("_processado_em").cast("timestamp_ntz"))


@query
def conform_indicators_long(spark, sf):
    return _silver_long(spark, sf)


def _stamps(spark, sf):
    return standins.events(spark, sf, *ROW, START, END)


@query
def duration_minutes_zero(spark, sf):
    return conform.with_duration(_stamps(spark, sf), START, END, null_as_zero=True)


@query
def duration_minutes_null(spark, sf):
    return conform.with_duration(_stamps(spark, sf), START, END)


@query
def duration_hours(spark, sf):
    return conform.with_duration(_stamps(spark, sf), START, END, "hours")


@query
def duration_triplet(spark, sf):
    return conform.with_duration_triplet(_stamps(spark, sf), START, END)


@query
def duration_minutes_trunc(spark, sf):
    whole = conform.with_duration(_stamps(spark, sf), START, END, whole_units=True)
    return whole.withColumn("duracao_horas", F.col("duracao_minutos") / F.lit(60.0))


@query
def duration_class(spark, sf):
    return conform.with_duration_class(conform.with_duration(_stamps(spark, sf), START, END))


@query
def duration_flag(spark, sf):
    return conform.with_duration_flag(_stamps(spark, sf), START, END)


@query
def duration_bands(spark, sf):
    banded = conform.with_duration_band(_stamps(spark, sf), START, END)
    return quality.class_distribution(banded, "faixa_duracao")


@query
def scheduled_flag(spark, sf):
    rows = standins.events(spark, sf, *ROW, "DscTipoInterrupcao")
    return conform.with_scheduled_flag(rows)


@query
def normalize_names(spark, sf):
    rows = standins.events(
        spark, sf, *ROW, START, "NumNivelTensao", "NumUnidadeConsumidora"
    ).withColumnsRenamed(
        {
            START: "Data de Início",
            "NumNivelTensao": "Tensão (V)",
            "NumUnidadeConsumidora": "UCs Atingidas/Região",
        }
    )
    return names.normalize_names(rows, "fold")


@query
def normalize_names_snake(spark, sf):
    return names.normalize_names(standins.events(spark, sf, *EVENT_COLUMNS), "snake")


@query
def trim_text(spark, sf):
    rows = standins.indicators(
        spark, sf, "sigagente", "dscconjundconsumidoras", "sigindicador", "_tie"
    )
    return conform.trim_text(rows, ["sigagente", "dscconjundconsumidoras"], upper=("sigagente",))


@query
def period_month(spark, sf):
    return _silver_measures(spark, sf).select("distribuidora", "ano", "mes", "data_apuracao", "_tie")


@query
def composite_key(spark, sf):
    keyed = indicators.wide_keys_text(_wide(spark, sf))
    return keyed.select(*v.INDICATOR_KEY, "chave_composta", "chave_uc")


@query
def cause_levels(spark, sf):
    rows = standins.events(spark, sf, *ROW, "DscFatoGeradorInterrupcao")
    return conform.with_cause_levels(rows, "DscFatoGeradorInterrupcao")


@query
def cnpj_format(spark, sf):
    return conform.with_cnpj(standins.events(spark, sf, *ROW, "NumCPFCNPJ"), "NumCPFCNPJ")


@query
def voltage_kv(spark, sf):
    return conform.with_voltage_kv(
        standins.events(spark, sf, *ROW, "NumNivelTensao"), "NumNivelTensao"
    )


@query
def calendar_fields(spark, sf):
    return conform.with_calendar(standins.events(spark, sf, *ROW, START), START)


@query
def enrich_region(spark, sf):
    rows = conform.trim_text(standins.events(spark, sf, *ROW, "SigAgente"), ["SigAgente"])
    return conform.enrich_region(rows, standins.agent_regions(spark, sf), "SigAgente")


# ---- filters ----------------------------------------------------------------


@query
def drop_critical_nulls(spark, sf):
    rows = standins.events(spark, sf, *v.CRITICAL_COLUMNS, "_tie")
    return filters.drop_nulls(rows, v.CRITICAL_COLUMNS)


@query
def null_drops(spark, sf):
    return filters.null_drops(standins.events(spark, sf, *v.CRITICAL_COLUMNS), v.CRITICAL_COLUMNS[::-1])


@query
def temporal_invalid(spark, sf):
    rows = standins.events(spark, sf, *ROW, START, END, "DscTipoInterrupcao")
    return filters.temporal_invalid(rows)


@query
def temporal_valid(spark, sf):
    return filters.temporal_valid(_stamps(spark, sf))


@query
def long_outages(spark, sf):
    return filters.long_outages(_stamps(spark, sf))


@query
def quality_filter(spark, sf):
    rows = standins.events(spark, sf, *ROW, START, END, "NumUnidadeConsumidora", "NumNivelTensao")
    return filters.quality_filter(rows)


@query
def dec_event_filter(spark, sf):
    rows = standins.events(
        spark, sf, *ROW, START, END, "DscTipoInterrupcao", "NumUnidadeConsumidora"
    )
    return filters.dec_event_filter(rows, v.TYPES_INCLUDED, v.TYPES_EXCLUDED)


@query
def cause_containing(spark, sf):
    rows = standins.events(spark, sf, *ROW, "DscFatoGeradorInterrupcao")
    return filters.containing(rows, "DscFatoGeradorInterrupcao", "ECONOMY")


@query
def invalid_class(spark, sf):
    classed = conform.with_duration_class(conform.with_duration(_stamps(spark, sf), START, END))
    known = [c for c in v.DURATION_CLASSES if c != v.CLASS_NONE]
    return filters.out_of_domain(classed, "classe_duracao", known)


@query
def indicators_slice(spark, sf):
    rows = indicators.indicators_slice(
        _silver_measures(spark, sf), ["DEC", "FEC"], dt.date(YEAR, 1, 1), month=8
    )
    return rows.select(
        "id_conjunto_uc", "conjunto_uc", "distribuidora", "indicador", "valor",
        "data_apuracao", "ano", "mes",
    )


# ---- deduplication ----------------------------------------------------------


@query
def dedupe_natural_key(spark, sf):
    return dedupe.latest_per_key(
        _silver_events(spark, sf), v.NATURAL_KEY, NATURAL_ORDER, ties=[]
    )


@query
def dedupe_order_number(spark, sf):
    rows = standins.events(
        spark, sf, "NumOrdemInterrupcao", "DatGeracaoConjuntoDados", START, END, "SigAgente", "_tie"
    )
    return dedupe.latest_per_key(rows, *ORDER_NUMBER, ties=[])


@query
def dedupe_order_uc(spark, sf):
    rows = standins.events(
        spark, sf, "NumOrdemInterrupcao", "NumUnidadeConsumidora", "DatGeracaoConjuntoDados",
        START, END, "_tie",
    )
    keys = ["NumOrdemInterrupcao", "NumUnidadeConsumidora"]
    return dedupe.latest_per_key(rows, keys, ORDER_NUMBER[1], ties=[])


@query
def dedupe_conjunto_start(spark, sf):
    rows = standins.events(
        spark, sf, "IdeConjuntoUnidadeConsumidora", START, "DatGeracaoConjuntoDados", END, "_tie"
    )
    keys = ["IdeConjuntoUnidadeConsumidora", START]
    return dedupe.latest_per_key(rows, keys, ORDER_NUMBER[1], ties=[])


@query
def dedupe_indicators(spark, sf):
    cells = indicators.latest_cells(_silver_long(spark, sf), ["ingest_ts_bronze", "_tie"], ties=[])
    return cells.select(*indicators.CELL_KEY, "valor", "ingest_ts_bronze")


@query
def dedupe_across_loads(spark, sf):
    """Years loaded in three calls, starts known to the month: events stand in several years."""
    bronze, silver = table_path(spark, "bronze_events"), table_path(spark, "silver_events")
    rows = standins.events(
        spark, sf, *EVENT_COLUMNS, "_ingest_timestamp", "_source_url", "_source_last_modified", "_ano_fonte"
    ).withColumns({START: F.date_trunc("month", START).cast("timestamp_ntz"),
                   "_ingest_timestamp": F.col("_ingest_timestamp").cast("timestamp")})
    tables.replace_all(rows, bronze, "_ano_fonte", placed=True)
    years = sorted(r["ano"] for r in standins.manifest(spark, sf).select("ano").collect())
    for chosen in (years[:3], years[4:], years[3:4]):
        medallion.silver_events(spark, bronze, silver, chosen, RUN)
    stored = spark.read.schema(medallion.SILVER_EVENTS).parquet(silver).drop("_silver_timestamp")
    return stored.withColumn("_ingest_timestamp", F.col("_ingest_timestamp").cast("timestamp_ntz"))


# ---- gold, pivots, reports --------------------------------------------------


@query
def gold_outage_month(spark, sf):
    return _gold_outages(spark, sf)


@query
def gold_outage_stamped(spark, sf):
    stamped = _gold_outages(spark, sf, run_ts=RUN)
    return stamped.withColumn("_gold_timestamp", F.col("_gold_timestamp").cast("timestamp_ntz"))


@query
def gold_outage_month_clipped(spark, sf):
    """Negative durations as zero, on events with no temporal filter before."""
    rows = conform.with_duration(
        standins.events(spark, sf, "SigAgente", START, END), START, END, null_as_zero=True
    )
    return outages.gold_outage_month(
        rows, "SigAgente", START, "duracao_minutos", clip_negative=True
    )


@query
def indicators_wide(spark, sf):
    return _wide(spark, sf)


@query
def indicators_wide_legacy(spark, sf):
    return _wide(spark, sf, legacy_columns=True)


@query
def conflicting_cells(spark, sf):
    """Cells under two registration numbers, with the supplier's number in place of the agent's."""
    rows = standins.indicators(spark, sf, *v.INDICATOR_KEY, "numcnpj", "_tie")
    return indicators.conflicting_cells(
        rows.withColumn("numcnpj", F.col("numcnpj") + F.floor(F.col("_tie")).cast("bigint") % 2)
    )


@query
def dec_fec_evolution(spark, sf):
    return indicators.dec_fec_evolution(_silver_measures(spark, sf), YEAR, min_consumers=4000)


@query
def gold_indicator_month(spark, sf):
    return _gold_indicators(spark, sf)


@query
def gold_indicator_month_strict(spark, sf):
    gold = _gold_indicators(spark, sf, strict_month=True)
    return gold.select("distribuidora", "ano", "mes", "dec_medio", "dec_medio_mes_anterior")


@query
def count_by_agent(spark, sf):
    counted = ranking.count_by(standins.events(spark, sf, "SigAgente"), "SigAgente")
    return ranking.top_k(counted, "qtd_registros", 5, ["SigAgente"])


@query
def count_by_type(spark, sf):
    return ranking.count_by(standins.events(spark, sf, "DscTipoInterrupcao"), "DscTipoInterrupcao")


@query
def count_by_indicator(spark, sf):
    return ranking.count_by(standins.indicators(spark, sf, "sigindicador"), "sigindicador")


@query
def count_by_year(spark, sf):
    counted = ranking.count_by(standins.indicators(spark, sf, "anoindice"), "anoindice")
    return counted.orderBy("anoindice")


@query
def count_by_cause(spark, sf):
    rows = conform.with_cause_levels(
        standins.events(spark, sf, "DscFatoGeradorInterrupcao"), "DscFatoGeradorInterrupcao"
    )
    counted = ranking.count_by(rows, "fato_gerador_origem")
    return ranking.top_k(counted, "qtd_registros", 10, ["fato_gerador_origem"])


@query
def dist_by_type(spark, sf):
    rows = standins.events(spark, sf, "DscTipoInterrupcao", "NumOrdemInterrupcao")
    return profiling.count_and_distinct(rows, "DscTipoInterrupcao", "NumOrdemInterrupcao")


@query
def dist_by_distributor(spark, sf):
    rows = standins.events(spark, sf, "SigAgente", "NomAgenteRegulado")
    return ranking.count_by(rows, "SigAgente", "NomAgenteRegulado")


@query
def dist_by_voltage(spark, sf):
    return ranking.count_by(standins.events(spark, sf, "NumNivelTensao"), "NumNivelTensao")


@query
def duration_stats(spark, sf):
    return profiling.duration_stats(standins.events(spark, sf, START, END), START, END)


@query
def duration_stats_sketch(spark, sf):
    return profiling.duration_stats_sketch(standins.events(spark, sf, START, END), START, END)


@query
def duration_stats_hours(spark, sf):
    stats = profiling.duration_stats_hours(standins.events(spark, sf, START, END), START, END)
    return stats.withColumn("desvio_padrao", F.round("desvio_padrao", 6))


@query
def longest_events(spark, sf):
    """The longest valid events with their class, as a sample of the final table."""
    kept = conform.with_duration_class(
        conform.with_duration(_valid_latest(spark, sf, "SigAgente", "DscTipoInterrupcao"), START, END)
    )
    return ranking.top_k(
        kept.drop("DatGeracaoConjuntoDados"), "duracao_minutos", 10, ["NumOrdemInterrupcao"]
    )


@query
def long_outage_share(spark, sf):
    return profiling.long_share(standins.events(spark, sf, START, END), START, END)


@query
def period_covered(spark, sf):
    return profiling.period_covered(standins.events(spark, sf, START), START)


@query
def period_covered_gold(spark, sf):
    return profiling.period_covered(_gold_indicators(spark, sf), "ano_mes")


@query
def distinct_agents(spark, sf):
    rows = standins.indicators(spark, sf, "sigagente")
    return profiling.distinct_members(rows, F.trim("sigagente"))


@query
def distinct_agents_sketch(spark, sf):
    rows = standins.indicators(spark, sf, "sigagente")
    return profiling.distinct_members(rows, F.trim("sigagente"), approximate=True)


def _stored_states(spark, sf, rows, member, value):
    """Sketch states of every event year, stored; one year is replaced once more."""
    path = table_path(spark, "sketch_states")
    states = sketches.year_states(rows.withColumn("ano", F.year(START)), "ano", member, value)
    tables.replace_all(states, path, "ano")
    tables.replace_years(states, path, "ano", [YEAR])
    return spark.read.schema(sketches.STATES + ", ano INT").parquet(path)


@query
def distinct_agents_stored_sketch(spark, sf):
    """Distinct agents and conjuntos from stored states, held against the exact number."""
    rows = standins.events(spark, sf, START, END, "SigAgente", "IdeConjuntoUnidadeConsumidora")
    pair = F.concat_ws("|", "SigAgente", "IdeConjuntoUnidadeConsumidora", F.to_date(START))
    states = _stored_states(spark, sf, rows, pair, durations.elapsed_seconds(START, END))
    exact = rows.agg(F.count_distinct(pair).alias("exato"))
    bound = 3 * 1.04 / 2 ** (sketches.LG_K / 2)
    estimate = sketches.distinct_from_states(states).scalar()
    return exact.select("exato", (F.abs(estimate - F.col("exato")) <= bound * F.col("exato")).alias("within_bound"))


@query
def duration_quantiles_stored_sketch(spark, sf):
    """Quantiles of durations from stored states, each held against its true rank."""
    rows = standins.events(spark, sf, START, END, "SigAgente")
    seconds = durations.elapsed_seconds(START, END)
    shares = {"mediana": 0.5, "p95": 0.95, "p99": 0.99}
    found = sketches.quantiles_from_states(_stored_states(spark, sf, rows, F.col("SigAgente"), seconds), shares)
    return sketches.quantile_check(rows, seconds, found, shares, 0.025)


@query
def indicator_stats(spark, sf):
    rows = standins.indicators(spark, sf, "sigindicador", "vlrindiceenviado")
    return indicators.value_stats(rows, "sigindicador", "vlrindiceenviado")


@query
def indicator_spread(spark, sf):
    stats = indicators.value_stats(_silver_measures(spark, sf), "indicador", "valor", spread=True)
    return stats.withColumn("desvio_padrao", F.round("desvio_padrao", 6))


@query
def top_outage_time(spark, sf):
    rows = conform.trim_text(standins.events(spark, sf, "SigAgente", START, END))
    return profiling.top_outage_time(
        rows.withColumnRenamed("SigAgente", "sig_agente"), "sig_agente", START, END
    )


@query
def top_mean_dec(spark, sf):
    return indicators.top_mean_dec(_silver_measures(spark, sf))


@query
def top_dec_year(spark, sf):
    top = indicators.top_dec_year(_gold_indicators(spark, sf), YEAR)
    return top.withColumn("dec_medio_anual", F.round("dec_medio_anual", 6))


@query
def gold_overall(spark, sf):
    overall = indicators.gold_overall(_gold_indicators(spark, sf))
    return overall.select(*[F.round(c, 6).alias(c) for c in overall.columns])


@query
def variation_stats(spark, sf):
    stats = indicators.variation_stats(_gold_indicators(spark, sf))
    return stats.select(*[F.round(c, 6).alias(c) for c in stats.columns])


@query
def coverage(spark, sf):
    return indicators.coverage(_silver_measures(spark, sf))


@query
def indicator_distribution(spark, sf):
    return indicators.indicator_distribution(_silver_measures(spark, sf))


@query
def top_volume(spark, sf):
    return indicators.top_volume(_silver_measures(spark, sf))


@query
def class_distribution(spark, sf):
    classed = conform.with_duration_class(
        conform.with_duration(standins.events(spark, sf, START, END), START, END)
    )
    return quality.class_distribution(classed, "classe_duracao")


@query
def cause_analysis(spark, sf):
    rows = conform.with_cause_levels(
        standins.events(
            spark, sf, "DscFatoGeradorInterrupcao", START, END, "NumUnidadeConsumidora"
        ),
        "DscFatoGeradorInterrupcao",
    )
    return profiling.cause_analysis(rows, v.CAUSE_LEVELS, START, END, "NumUnidadeConsumidora")


@query
def cause_rollup(spark, sf):
    rows = conform.with_cause_levels(
        standins.events(
            spark, sf, "DscFatoGeradorInterrupcao", START, END, "NumUnidadeConsumidora"
        ),
        "DscFatoGeradorInterrupcao",
    )
    return profiling.cause_rollup(rows, v.CAUSE_LEVELS, START, END, "NumUnidadeConsumidora")


@query
def conjunto_ranking(spark, sf):
    rows = filters.quality_filter(
        standins.events(
            spark, sf, "SigAgente", "IdeConjuntoUnidadeConsumidora", START, END,
            "NumUnidadeConsumidora", "NumNivelTensao",
        )
    )
    return profiling.conjunto_ranking(
        rows, "SigAgente", "IdeConjuntoUnidadeConsumidora", START, END
    )


@query
def consumers_stats(spark, sf):
    rows = standins.events(spark, sf, "NumUnidadeConsumidora")
    return profiling.consumers_stats(rows, "NumUnidadeConsumidora")


# ---- checks and reconciliation ----------------------------------------------


@query
def check_columns(spark, sf):
    rows = standins.events(spark, sf, *EVENT_COLUMNS)
    return quality.check_columns(rows, [*v.CRITICAL_COLUMNS, START, END, "DscMotivo"])


@query
def check_report(spark, sf):
    rows = conform.with_duration_class(
        conform.with_duration(
            standins.events(spark, sf, *v.CRITICAL_COLUMNS, START, END, "NumUnidadeConsumidora"),
            START, END,
        )
    )
    return quality.check_report(
        rows,
        columns=[*v.CRITICAL_COLUMNS, "DscMotivo"],
        key=["NumOrdemInterrupcao"],
        not_null=v.CRITICAL_COLUMNS,
        ranges={"duracao_minutos": (0, None), "NumUnidadeConsumidora": (1, None)},
        domains={"classe_duracao": v.DURATION_CLASSES},
        conditions={"temporal": filters.reversed_or_empty()},
        soft=("faixa:duracao_minutos",),
    )


@query
def dup_keys(spark, sf):
    return quality.duplicate_keys(
        standins.events(spark, sf, "NumOrdemInterrupcao"), ["NumOrdemInterrupcao"]
    )


@query
def check_unique(spark, sf):
    kept = dedupe.latest_per_key(_silver_events(spark, sf), v.NATURAL_KEY, NATURAL_ORDER, ties=[])
    return quality.check_unique(kept, v.NATURAL_KEY)


@query
def check_nulls(spark, sf):
    return quality.check_nulls(standins.events(spark, sf, *v.CRITICAL_COLUMNS), v.CRITICAL_COLUMNS)


@query
def check_range(spark, sf):
    rows = conform.with_duration(standins.events(spark, sf, START, END), START, END)
    return quality.check_range(rows, "duracao_minutos")


@query
def check_duration(spark, sf):
    kept = conform.with_duration(_valid_latest(spark, sf), START, END)
    return quality.check_duration(kept, START, END, "duracao_minutos")


@query
def check_classes(spark, sf):
    kept = conform.with_duration(_valid_latest(spark, sf), START, END)
    return quality.check_classes(
        conform.with_duration_class(kept), "classe_duracao", v.DURATION_CLASSES
    )


@query
def reconcile_counts(spark, sf):
    keyed = _silver_events(spark, sf).select(*v.NATURAL_KEY)
    return quality.reconcile_counts(keyed, v.NATURAL_KEY, "data_inicio")


@query
def reconcile_sum_silver(spark, sf):
    return quality.reconcile_dedupe_sum(
        _silver_events(spark, sf), v.NATURAL_KEY, NATURAL_ORDER, "tempo_interrupcao_minutos"
    )


@query
def reconcile_sum_gold(spark, sf):
    """Silver stored once, then read by the gold aggregation and by the check."""
    path = table_path(spark, "silver_minutes")
    conform.with_duration(
        _valid_latest(spark, sf, "SigAgente"), START, END, null_as_zero=True
    ).select("SigAgente", START, "duracao_minutos").write.parquet(path)
    silver = spark.read.schema(
        f"SigAgente STRING, {START} TIMESTAMP_NTZ, duracao_minutos DOUBLE"
    ).parquet(path)
    gold = outages.gold_outage_month(silver, "SigAgente", START, "duracao_minutos")
    return quality.reconcile_sum(
        silver, gold, "duracao_minutos", "tempo_total_minutos", tolerance_pct=0.01
    )


@query
def reconcile_steps(spark, sf):
    rows = standins.events(
        spark, sf, "NumOrdemInterrupcao", "DatGeracaoConjuntoDados", START, END, "_tie"
    )
    return quality.reconcile_steps(rows, *ORDER_NUMBER, START, END)


@query
def filtered_share(spark, sf):
    rows = standins.events(spark, sf, START, END, "NumUnidadeConsumidora", "NumNivelTensao")
    kept = (F.col("NumUnidadeConsumidora") > 0) & (F.col(END) > F.col(START)) & (
        F.col("NumNivelTensao") != 0
    )
    return quality.filtered_share(rows, kept)


@query
def null_keys(spark, sf):
    return quality.null_keys(
        _silver_measures(spark, sf),
        ["id_conjunto_uc", "conjunto_uc", "distribuidora", "indicador", "valor", "data_apuracao"],
    )


# ---- profiles ---------------------------------------------------------------


@query
def profile_nulls(spark, sf):
    return profiling.profile_nulls(standins.events(spark, sf, *EVENT_COLUMNS))


@query
def profile_blanks(spark, sf):
    return profiling.profile_blanks(standins.events(spark, sf, *EVENT_COLUMNS))


@query
def profile_temporal(spark, sf):
    return profiling.profile_temporal(standins.events(spark, sf, START, END), START, END)


@query
def profile_duplicates(spark, sf):
    return profiling.profile_duplicates(
        standins.events(spark, sf, "NumOrdemInterrupcao"), ["NumOrdemInterrupcao"]
    )


@query
def duplicate_examples(spark, sf):
    rows = standins.events(spark, sf, *ROW, "DatGeracaoConjuntoDados", START, END, "SigAgente")
    return profiling.duplicate_examples(rows, ["NumOrdemInterrupcao"])


@query
def quality_summary(spark, sf):
    critical = [
        "NumOrdemInterrupcao", START, END, "DscTipoInterrupcao", "NumUnidadeConsumidora",
        "NumConsumidorConjunto",
    ]
    return profiling.quality_summary(
        standins.events(spark, sf, *critical), critical,
        ["NumOrdemInterrupcao", "NumUnidadeConsumidora"], "NumUnidadeConsumidora", START, END,
    )


# ---- observed against published ---------------------------------------------


@query
def dec_observed(spark, sf):
    return compare.dec_observed(_observed(spark, sf), _official(spark, sf))


@query
def fec_observed(spark, sf):
    return compare.fec_observed(_observed(spark, sf))


@query
def dec_comparison(spark, sf):
    return compare.dec_comparison(_observed(spark, sf), _official(spark, sf))


@query
def dec_analysis_stored(spark, sf):
    path = table_path(spark, "dec_analysis")
    events = standins.events(
        spark, sf, "SigAgente", START, END, "NumUnidadeConsumidora", "NumNivelTensao",
        "IdeConjuntoUnidadeConsumidora", "NumConsumidorConjunto", "DscTipoInterrupcao",
    )
    medallion.dec_analysis(events, _conjuntos(spark, sf, compare.INDEX_CODES), path)
    wanted = dec_comparison(spark, sf).schema
    return spark.read.schema(wanted).parquet(path).select(*wanted.names)


@query
def above_limit(spark, sf):
    yearly = indicators.annual_means(_conjuntos(spark, sf, ["DEC", "FEC"]))
    limits = standins.dec_limits(spark, sf)
    return compare.above_limit(yearly, limits).drop("fec_medio")


@query
def limit_as_of(spark, sf):
    monthly = _gold_indicators(spark, sf).select("distribuidora", "ano", "mes", "ano_mes", "dec_medio")
    held = compare.limit_as_of(monthly, standins.dated_limits(spark, sf), "dec_medio", "ano_mes")
    return held.drop("ano_mes")


@query
def fec_by_region(spark, sf):
    return compare.fec_by_region(
        _conjuntos(spark, sf, ["FEC"]), standins.agent_regions(spark, sf)
    )


# ---- business questions -----------------------------------------------------


@query
def bq_worst_distributor_year(spark, sf):
    return outages.worst_distributors(_gold_outages(spark, sf), YEAR, k=10)


@query
def bq_monthly_trend(spark, sf):
    return outages.monthly_trend(_gold_outages(spark, sf))


@query
def bq_events_month(spark, sf):
    return outages.events_by_month(_gold_outages(spark, sf))


@query
def bq_mean_dec_year(spark, sf):
    return indicators.mean_dec_by_year(_wide(spark, sf))


@query
def bq_top_cause(spark, sf):
    rows = standins.events(spark, sf, "SigAgente", "DscFatoGeradorInterrupcao")
    return profiling.top_cause(rows, "SigAgente", "DscFatoGeradorInterrupcao")


@query
def bq_month_jumps(spark, sf):
    return indicators.month_jumps(_gold_indicators(spark, sf), 50.0)


@query
def bq_robust_jumps(spark, sf):
    return indicators.robust_jumps(_gold_indicators(spark, sf), threshold=2.0)


@query
def bq_month_rank(spark, sf):
    return indicators.month_rank(_gold_indicators(spark, sf), 3)


@query
def bq_annual_means(spark, sf):
    return indicators.annual_means(_conjuntos(spark, sf, ["DEC", "FEC"]))


@query
def bq_missing_months(spark, sf):
    rows = standins.events(spark, sf, "SigAgente", "IdeConjuntoUnidadeConsumidora", START)
    dated = rows.select(
        "SigAgente", "IdeConjuntoUnidadeConsumidora",
        F.year(START).alias("ano"), F.month(START).alias("mes"),
    )
    return outages.missing_months(
        dated, ["SigAgente", "IdeConjuntoUnidadeConsumidora"], "ano", "mes"
    )


@query
def bq_missing_ranges(spark, sf):
    rows = standins.events(spark, sf, "SigAgente", "IdeConjuntoUnidadeConsumidora", START)
    dated = rows.select(
        "SigAgente", "IdeConjuntoUnidadeConsumidora",
        F.year(START).alias("ano"), F.month(START).alias("mes"),
    )
    return outages.missing_ranges(
        dated, ["SigAgente", "IdeConjuntoUnidadeConsumidora"], "ano", "mes"
    )
