"""What each stage wrote, kept as a table: reconciliation reads it and not the layers again."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

METRICS_SCHEMA = """execucao TIMESTAMP, fluxo STRING, ordem INT, etapa STRING, ano INT, arquivo STRING,
    medida STRING, valor BIGINT"""
#: stages of each flow, in the order in which rows pass them
STAGES = {"interrupcoes": ["bronze", "silver", "gold"], "indicadores": ["bronze", "silver", "largo", "gold"]}


def record(
    spark: SparkSession, path: str | None, run_ts: dt.datetime, flow: str, stage: str,
    measured: dict[tuple[int | None, str | None], dict[str, int]],
) -> None:
    """Append what a stage observed while it wrote: measures by (year, file).

    Nothing is recorded without a path. A year written again is measured again, and its
    newest run counts, so two runs never share a stamp.
    """
    rows = [
        (run_ts, flow, STAGES[flow].index(stage), stage, year, file, name, value)
        for (year, file), values in measured.items() for name, value in values.items()
    ]
    if path is not None and rows:
        spark.createDataFrame(rows, METRICS_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS_SCHEMA).parquet(path)


def run_summary(metrics: DataFrame) -> DataFrame:
    """One row per flow and stage: what it holds now, and what the stage before held.

    A year or file that was written several times counts with its newest run. ``linhas`` are
    rows, ``eventos`` what rows stand for where a stage sums them up, ``segundos`` exact
    durations; ``removidos`` is the fall in events from the stage before. The table has a few
    rows a run, however large the layers are.
    """
    newest = metrics.groupBy("fluxo", "ordem", "etapa", "ano", "arquivo", "medida").agg(
        F.max_by("valor", "execucao").alias("valor"), F.max("execucao").alias("execucao"))

    def total(name: str):
        return F.sum(F.when(F.col("medida") == name, F.col("valor")))

    held = newest.groupBy("fluxo", "ordem", "etapa").agg(
        F.max("execucao").alias("ultima_execucao"), F.count_distinct("ano").alias("anos"),
        total("linhas").alias("linhas"), F.coalesce(total("eventos"), total("linhas")).alias("eventos"),
        total("segundos").alias("segundos"))
    before = Window.partitionBy("fluxo").orderBy("ordem")
    return held.select(
        "fluxo", "etapa", "ultima_execucao", "anos", "linhas", "eventos",
        (F.lag("eventos").over(before) - F.col("eventos")).alias("removidos"),
        "segundos", (F.col("segundos") - F.lag("segundos").over(before)).alias("diferenca_segundos"))
