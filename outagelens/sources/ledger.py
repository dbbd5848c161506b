"""The ingestion ledger: what was loaded, in which version, and what is still pending."""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outagelens import vocabulary as v

#: a landed file is its URL within a source and year; a new stamp is a new version of it
FILE_KEY = ["fonte", "ano", "url"]
VERSION_KEY = [*FILE_KEY, "last_modified"]


def _unmatched(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys ``known`` does not hold; a missing key equals a missing one."""
    other = known.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return rows.join(other, same, "left_anti")


def pending(manifest: DataFrame, ledger: DataFrame, by_version: bool = True) -> DataFrame:
    """Manifest rows (fonte, ano, url, last_modified) not yet loaded with success.

    A year may land as several files, each settled for itself. By version a republished file
    is pending again; otherwise any success of the file settles it.
    """
    done = ledger.filter(F.col("status") == v.SUCCESS)
    return _unmatched(manifest, done, VERSION_KEY if by_version else FILE_KEY)


def ledger_entries(
    manifest: DataFrame, outcome: DataFrame, run_ts: dt.datetime
) -> DataFrame:
    """One ledger row per attempted manifest row.

    ``outcome`` holds num_registros and erro, the rows loaded or the reason nothing was, by
    those columns of the version key that it has; with several files a year that has to
    include ``url``. No outcome, no rows or a reason all make an error row, whose version
    stays empty so that the next run tries again. ``rejeitadas``, if it is there, tells how
    many lines of the file were put aside.
    """
    keys = [k for k in VERSION_KEY if k in outcome.columns]
    other = outcome.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    attempted = manifest.join(other, same, "left")
    aside = F.col("rejeitadas") if "rejeitadas" in outcome.columns else F.lit(0)
    done = F.when(aside > 0, F.format_string("carga concluida, %d linhas rejeitadas", aside)).otherwise("carga concluida")
    good = F.col("erro").isNull() & (F.coalesce(F.col("num_registros"), F.lit(0)) > 0)
    return attempted.select(
        "fonte",
        F.col("ano").cast("int").alias("ano"),
        "url",
        F.when(good, F.col("last_modified")).otherwise("").alias("last_modified"),
        F.when(good, v.SUCCESS).otherwise(v.ERROR).alias("status"),
        F.lit(run_ts).cast("timestamp").alias("timestamp_ingestao"),
        F.when(good, F.col("num_registros")).otherwise(0).cast("bigint").alias("num_registros"),
        F.when(good, done)
        .otherwise(F.coalesce(F.col("erro"), F.lit("sem registros")))
        .alias("mensagem"),
    )


def ledger_summary(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("fonte").agg(
        F.count(F.lit(1)).alias("total_ingestoes"),
        F.count_if(F.col("status") == v.SUCCESS).alias("sucessos"),
        F.count_if(F.col("status") == v.ERROR).alias("erros"),
        F.sum("num_registros").alias("total_registros"),
        F.max("timestamp_ingestao").alias("ultima_ingestao"),
    )


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger so far; empty before the first run."""
    try:
        return spark.read.schema(v.LEDGER_SCHEMA).parquet(path)
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], v.LEDGER_SCHEMA)


def append_entries(entries: DataFrame, path: str) -> None:
    """Append, keeping at most one success per file and version."""
    known = read_ledger(entries.sparkSession, path).filter(F.col("status") == v.SUCCESS)
    fresh = _unmatched(entries, known, VERSION_KEY)
    fresh.select(*entries.columns).coalesce(1).write.mode("append").parquet(path)
