"""The layers end to end: landed files to bronze, silver and gold tables.

Every table is partitioned Parquet and every step replaces whole partitions, so a step
that died half-way is simply run again. Row counts come from metrics observed during the
write; rules are checked in one aggregate per table before the next layer reads it.
"""

from __future__ import annotations

import datetime as dt
import functools
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from outagelens import vocabulary as v
from outagelens.functions import calendar, durations
from outagelens.operators import compare, conform, dedupe, filters, indicators, outages, quality
from outagelens.operators.names import normalize_names
from outagelens.plans import merging
from outagelens.session import pin_utc
from outagelens.sources import landed as landed_files
from outagelens.sources import ledger, metrics, readers, tables

SOURCE, SERIES = "interrupcoes", "indicadores"
BRONZE_EXTRA = """, _ingest_timestamp TIMESTAMP, _source_url STRING,
    _source_last_modified STRING, _ano_fonte INT"""
#: a version of a file is a partition; its URL stands there as a digest, as names are short
BRONZE_PARTITIONS = ["_ano_fonte", "_source_last_modified", "_source_file"]
SILVER_EVENTS = """cod_distribuidora STRING, data_inicio TIMESTAMP_NTZ, conjunto STRING,
    tipo_interrupcao STRING, data_fim TIMESTAMP_NTZ, origem_interrupcao STRING,
    tempo_interrupcao_minutos DOUBLE, _ingest_timestamp TIMESTAMP, _source_url STRING,
    _source_last_modified STRING, _silver_timestamp TIMESTAMP, _ano_fonte INT"""
SILVER_ORDER = ["_ingest_timestamp", "data_fim"]


def ingest_events(
    spark: SparkSession, manifest: DataFrame, bronze_path: str, ledger_path: str,
    run_ts: dt.datetime, metrics_path: str | None = None, rejected_path: str | None = None,
) -> DataFrame:
    """Load the landed files of a manifest that the ledger does not know yet.

    All pending files are read as one table, twice: key columns only, to find per file what
    cannot be read or holds rows without them, then whole, into bronze. Rows know their file,
    so each gets the stamp of its own manifest row; no file waits for another. A file that
    fails becomes an error row and does not stop the others.

    Bronze keeps every version of every file in a partition of its own, replaced as a whole.
    Data is written first and the ledger row after, so a crash in between is repaired by
    the next run. Only the manifest and one line per file reach the driver.

    Files are Parquet; with ``rejected_path`` they are delimited text with a header. Lines that
    don't fit the schema then go there, in the same partitions as the rest goes to bronze,
    with file and reason, and the ledger counts them.
    """
    pin_utc(spark)
    pending = ledger.pending(manifest, ledger.read_ledger(spark, ledger_path))
    todo = pending.select(*ledger.VERSION_KEY).distinct().collect()
    items = list(enumerate(todo))

    def landed(chosen: list) -> DataFrame:
        urls = [item["url"] for _, item in chosen]
        if rejected_path is None:
            return landed_files.with_file_path(readers.read_events(spark, urls if len(urls) > 1 else urls[0]))
        return landed_files.with_file_path(readers.read_csv_checked(spark, urls, v.EVENT_SCHEMA))

    def probe(chosen: list) -> dict[int, list[tuple]]:
        # a row without key, agent and start: the file has other columns than declared
        empty = ~filters.any_present(["NumOrdemInterrupcao", "SigAgente", "DatInicioInterrupcao"])
        fits = F.lit(True) if rejected_path is None else F.col(readers.RAW_LINE).isNull()
        per_file = landed(chosen).groupBy(landed_files.FILE_PATH).agg(
            F.count_if(fits).alias("linhas"), F.count_if(fits & empty).alias("vazias"),
            F.count_if(~fits).alias("rejeitadas")).collect()
        owners = landed_files.owners(spark, [item["url"] for _, item in chosen], [r[0] for r in per_file])
        found: dict[int, list[tuple]] = {place: [] for place, _ in chosen}
        for row in per_file:
            for k in owners[row[0]]:
                found[chosen[k][0]].append(tuple(row))
        return found

    seen, problems = landed_files.by_halves(items, probe)
    for place, files in seen.items():
        if empty := sum(f[2] for f in files):
            problems[place] = f"checks failed: linha_vazia={empty}"

    def store(chosen: list, part, path: str, column: int) -> None:
        """Those rows of the files that ``part`` leaves, as many as the probe found."""
        files = [
            {landed_files.FILE_PATH: f[0], "url": item["url"], "ano": item["ano"], "last_modified": item["last_modified"],
             "_source_file": hashlib.md5(item["url"].encode()).hexdigest()}
            for place, item in chosen for f in seen[place] if f[column]
        ]
        if not files:
            return
        stamped = readers.stamp(
            landed_files.with_owner(part(landed(chosen)), files), "source", F.col("url"), run_ts,
            F.col("last_modified"), F.col("ano"),
        ).drop("url", "ano", "last_modified")
        # a file's rows go to its own partition: tasks that scan files already hold few of them
        written = tables.replace_partitions(stamped, path, BRONZE_PARTITIONS, placed=True)
        expected = sum(f[column] for place, _ in chosen for f in seen[place])
        if written != expected:
            raise ValueError(f"{written} rows written of {expected} found in the files")

    def load(chosen: list) -> dict[int, tuple[int, int]]:
        store(chosen, (lambda rows: rows) if rejected_path is None else readers.accepted, bronze_path, 1)
        if rejected_path is not None:
            bad = [(place, item) for place, item in chosen if any(f[3] for f in seen[place])]
            store(bad, lambda rows: readers.rejected(rows, v.EVENT_SCHEMA), rejected_path, 3)
        return {place: (sum(f[1] for f in seen[place]), sum(f[3] for f in seen[place])) for place, _ in chosen}

    counts, failed = landed_files.by_halves([(p, item) for p, item in items if p not in problems], load)
    problems |= failed
    outcome = spark.createDataFrame(
        [(*item, *counts.get(place, (0, 0)), problems.get(place)) for place, item in items],
        "fonte STRING, ano INT, url STRING, last_modified STRING, num_registros BIGINT, rejeitadas BIGINT, erro STRING",
    )
    entries = ledger.ledger_entries(outcome.select(*ledger.VERSION_KEY), outcome, run_ts)
    metrics.record(spark, metrics_path, run_ts, SOURCE, "bronze", {
        (item["ano"], item["url"]): {"linhas": counts[place][0]} for place, item in items if place in counts})
    ledger.append_entries(entries, ledger_path)
    return entries


def newest_version(bronze: DataFrame) -> DataFrame:
    """The rows of the newest version of each file.

    A file is a URL within a year, so a year that landed as several files keeps them all.
    What an older version holds and the newest does not was withdrawn or corrected. Stamps
    are compared as instants; one that names no instant counts as of its ingestion. Files
    without a version are older than any with one.

    The versions are found here and now, by a scan of what names them; one line per replaced
    version reaches the driver. Most tables hold none, and their rows go on as they are;
    otherwise rows are matched with that short list, so they are never dealt by file.
    """
    have = bronze.columns
    stamp = F.col("_source_last_modified")
    url = F.col("_source_url") if "_source_url" in have else F.lit(None).cast("string")
    ingested = F.col("_ingest_timestamp") if "_ingest_timestamp" in have else F.lit(None).cast("timestamp")
    # one maximum of fixed width per version: hashed, where a maximum by several columns would sort all rows
    versions = bronze.groupBy(F.col("_ano_fonte").alias("_year"), url.alias("_file"), stamp.alias("_version")).agg(
        F.max(ingested).alias("_at"))
    version = F.col("_version")
    newest_first = [version.isNotNull(), F.coalesce(calendar.stamp_instant(version), F.col("_at")), F.col("_at"), version]
    place = F.row_number().over(
        Window.partitionBy("_year", "_file").orderBy(*[c.desc_nulls_last() for c in newest_first]))
    replaced = versions.withColumn("_place", place).filter(F.col("_place") > 1).select("_year", "_file", "_version").collect()
    if not replaced:
        return bronze
    listed = bronze.sparkSession.createDataFrame(pa.Table.from_pylist([r.asDict() for r in replaced], pa.schema(
        [("_year", pa.int64()), ("_file", pa.string()), ("_version", pa.string())])))
    return bronze.join(
        listed,
        F.col("_ano_fonte").eqNullSafe(F.col("_year"))
        & url.eqNullSafe(F.col("_file"))
        & stamp.eqNullSafe(F.col("_version")),
        "left_anti",
    )


def silver_events(
    spark: SparkSession, bronze_path: str, silver_path: str, years: list[int],
    run_ts: dt.datetime, metrics_path: str | None = None,
) -> dict[str, int]:
    """Conform the given source years and merge them into silver, one row per event.

    An event that also stands in the file of another year is kept once, its newest row, as
    if both years had been loaded at once; only years that share an event are rewritten
    besides. Returns the rows of each stage: read and usable from a scan of one column,
    written from the write itself.
    """
    pin_utc(spark)

    @functools.cache
    def of_years(*chosen: int) -> DataFrame:
        return newest_version(readers.read_events(spark, bronze_path, list(chosen), BRONZE_EXTRA)).drop("_source_file")

    def newest(chosen: list[int]) -> DataFrame:
        return of_years(*chosen)  # the versions of the same years are looked for once

    written = merging.merge_years(
        spark, lambda chosen: conform.conform_events(newest(chosen)), silver_path, years,
        v.NATURAL_KEY, SILVER_ORDER, "_ano_fonte", {"_silver_timestamp": F.lit(run_ts)}, ["data_inicio"],
        {"segundos": durations.exact_seconds(F.col("tempo_interrupcao_minutos"))},
    )
    metrics.record(spark, metrics_path, run_ts, SOURCE, "silver", {(y, None): of for y, of in written.items()})
    kept = sum(written[y]["linhas"] for y in years)
    read = newest(years).agg(
        F.count(F.lit(1)).alias("bronze"), F.count("DatInicioInterrupcao").alias("conformado")
    ).first()
    return {
        "bronze": read["bronze"],
        "conformado": read["conformado"],
        "silver": kept,
        "excluidos_data_nula": read["bronze"] - read["conformado"],
        "duplicatas_removidas": read["conformado"] - kept,
        "linhas_reescritas": sum(of["linhas"] for of in written.values()) - kept,
    }


def gold_outages(
    spark: SparkSession, silver_path: str, gold_path: str, years: list[int],
    run_ts: dt.datetime, tolerance_pct: float = 0.01, metrics_path: str | None = None,
) -> dict[str, int]:
    """Monthly totals of events that began in the given years, replaced in gold.

    The years are those of the event, whichever file delivered it, so no event is lost
    between file year and event year. Silver is read twice: once for all checks and its
    sum, once for the totals, which are staged, reconciled, and only then replace the
    years in gold.
    """
    pin_utc(spark)
    in_period = None
    for year in years:
        begun = (F.col("data_inicio") >= F.lit(f"{year}-01-01").cast("timestamp_ntz")) & (
            F.col("data_inicio") < F.lit(f"{year + 1}-01-01").cast("timestamp_ntz")
        )
        in_period = begun if in_period is None else in_period | begun
    silver = spark.read.schema(SILVER_EVENTS).parquet(silver_path).filter(in_period)
    minutes = F.col("tempo_interrupcao_minutos")
    found = quality.require(
        quality.check_report(
            silver,
            columns=["cod_distribuidora", "data_inicio", "tempo_interrupcao_minutos"],
            not_null=["cod_distribuidora", "data_inicio"],
            ranges={"tempo_interrupcao_minutos": (0, None)},
            soft=("faixa:tempo_interrupcao_minutos",),
            totals={"segundos": durations.exact_seconds(minutes)},
        )
    )
    gold = outages.gold_outage_month(silver, run_ts=run_ts).withColumn(
        "_ano_fonte", F.col("ano_referencia")
    )
    staging = f"{gold_path}_staging"
    tables.replace_all(gold, staging, "_ano_fonte")
    staged = spark.read.schema(gold.schema).parquet(staging)
    held = quality.require(
        quality.check_report(
            staged,
            key=v.OUTAGE_MONTH_KEY,
            totals={"segundos": durations.exact_seconds(F.col("tempo_total_minutos"))},
        )
    )
    before, after = found["total:segundos"], held["total:segundos"]
    if before > 0 and abs(before - after) / before * 100 > tolerance_pct:
        raise ValueError(f"gold holds {after:g} s of the {before:g} s in silver")
    written = tables.replace_years_measured(
        staged, gold_path, "_ano_fonte", years,
        totals={"eventos": F.col("total_eventos"), "segundos": durations.exact_seconds(F.col("tempo_total_minutos"))},
    )
    metrics.record(spark, metrics_path, run_ts, SOURCE, "gold", {(y, None): of for y, of in written.items()})
    return {
        "linhas": sum(of["linhas"] for of in written.values()),
        "segundos_silver": int(before),
        "segundos_gold": int(after),
    }


def ingest_indicators(
    spark: SparkSession, landing: str, bronze_path: str, years: list[int], run_ts: dt.datetime,
    metrics_path: str | None = None,
) -> dict[int, int]:
    """Landed indicator series to bronze: stamped, names folded, given years replaced.

    The column names are those of the file, in whatever case and accents it has them, and
    are checked after folding. Returns the rows written per year.
    """
    pin_utc(spark)
    stamped = readers.stamp(spark.read.parquet(landing), "run", landing, run_ts)
    bronze = normalize_names(stamped, "fold")
    quality.require(
        quality.check_report(
            bronze, columns=["anoindice", "sigagente", "sigindicador", "vlrindiceenviado"]
        )
    )
    written = tables.replace_years_measured(bronze, bronze_path, "anoindice", years, ["sigindicador"])
    metrics.record(spark, metrics_path, run_ts, SERIES, "bronze", {(y, None): of for y, of in written.items()})
    return {y: of["linhas"] for y, of in written.items()}


def indicator_tables(
    spark: SparkSession, bronze: DataFrame, silver_path: str, gold_path: str,
    run_ts: dt.datetime, metrics_path: str | None = None, placed: bool = False,
) -> DataFrame:
    """Silver long and monthly gold from bronze indicator series, both replaced whole.

    The source republishes its full history in each file, and the month before may lie in
    another year, so both are rebuilt; gold reads the stored silver. Bronze scanned from a table
    by year is ``placed``: its rows are not dealt by year again. Returns the silver check report.
    """
    pin_utc(spark)
    silver = conform.conform_indicators_long(bronze, run_ts)
    landed = tables.replace_all(silver, silver_path, "ano", placed)
    stored = spark.read.schema(silver.schema).parquet(silver_path)
    report = quality.check_report(
        stored,
        not_null=["id_conjunto_uc", "distribuidora", "indicador", "data_apuracao"],
        ranges={"valor": (0, None), "mes": (1, 12)},
        soft=("faixa:valor",),
    )
    quality.require(report)
    months = indicators.conjunto_month(
        stored, ["ingest_ts_bronze", "data_geracao_fonte", "cnpj"], indicators.GOLD_CODES, every_code=True
    )
    gold = indicators.gold_indicator_month(months, run_ts=run_ts)
    months_written = tables.replace_all(gold, gold_path, "ano")
    for stage, rows in (("silver", landed), ("gold", months_written)):
        metrics.record(spark, metrics_path, run_ts, SERIES, stage, {(None, None): {"linhas": rows}})
    return report


def wide_indicators(
    spark: SparkSession, bronze: DataFrame, wide_path: str, years: list[int], run_ts: dt.datetime,
    metrics_path: str | None = None,
) -> dict[str, int]:
    """The wide silver table of the given years: pivoted, checked, replaced, summed up.

    A row without agent or a valid period has no key and is left out; keys held by several
    rows stop the run before anything is replaced. Returns the rows of each step; the cells
    given and the newest ones among them are counted in the aggregation that finds repeated
    cells.
    """
    pin_utc(spark)
    given = filters.in_years(bronze, "anoindice", years)
    cells = given.groupBy(*v.INDICATOR_KEY, "sigindicador").agg(F.count(F.lit(1)).alias("n"))
    read = cells.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("lidas"), F.count(F.lit(1)).alias("celulas")).first()
    wide = indicators.indicators_wide(given, ["_ingest_ts", "datgeracaoconjuntodados"], run_ts=run_ts)
    staging = f"{wide_path}_staging"
    tables.replace_all(wide, staging, "anoindice")
    staged = spark.read.schema(wide.schema).parquet(staging)
    found = quality.require(quality.check_report(
        staged, key=v.INDICATOR_KEY, not_null=["chave_uc", "periodo_apuracao"],
        soft=("nulos:chave_uc", "nulos:periodo_apuracao"), totals={"linhas": F.lit(1)}))
    valid = filters.drop_nulls(staged, ["chave_uc", "periodo_apuracao"])
    written = tables.replace_years_measured(valid, wide_path, "anoindice", years)
    metrics.record(spark, metrics_path, run_ts, SERIES, "largo", {(y, None): of for y, of in written.items()})
    rows = sum(of["linhas"] for of in written.values())
    return {
        "bronze": read["lidas"],
        "duplicatas_removidas": read["lidas"] - read["celulas"],
        "linhas_largas": int(found["total:linhas"]),
        "invalidas_removidas": int(found["total:linhas"]) - rows,
        "silver": rows,
    }


def processed_events(
    bronze: DataFrame, regions: DataFrame, run_ts: dt.datetime, origin: str
) -> DataFrame:
    """Valid events, deduplicated by order number and consumer unit, fully derived and
    enriched with the distributor's region."""
    valid = filters.quality_filter(bronze)
    kept = dedupe.latest_per_key(
        valid,
        ["NumOrdemInterrupcao", "NumUnidadeConsumidora"],
        ["DatGeracaoConjuntoDados", "DatFimInterrupcao"],
    )
    detailed = conform.conform_events_detailed(kept, run_ts, origin)
    return conform.enrich_region(detailed, regions, "sig_agente")


def dec_analysis(
    events: DataFrame, conjuntos: DataFrame, path: str, exclude: list[str] | None = None
) -> int:
    """Observed against published DEC, stored by year; returns the rows written.

    ``events`` are bronze events, ``conjuntos`` conjunto months with the index codes.
    """
    counted = filters.dec_event_filter(
        filters.quality_filter(events), exclude=exclude or v.TYPES_EXCLUDED
    )
    compared = compare.dec_comparison(
        compare.observed_month(counted), compare.official_month(conjuntos)
    )
    return tables.replace_all(compared, path, "ano")
