"""Latest row per key, with a total order, and the audit of what it removes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _newest_first(columns: list[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def latest_per_key(
    df: DataFrame, keys: list[str], order: list[str], ties: list[str] | None = None
) -> DataFrame:
    """Keep one row per key: greatest in ``order``, missing values last.

    ``ties`` breaks equal rows; by default every other column does, so the result never
    depends on arrival order. Project to the columns in use first, or pass ``ties=[]``
    when ``order`` is already total, so that the scan stays narrow.

    The optimizer turns the filter on the row number into a group limit that runs before
    the exchange too: a key holding a third of the table reaches the reducer as one row
    per map task, not as a third of the table.
    """
    if ties is None:
        ties = [c for c in df.columns if c not in keys and c not in order]
    newest = Window.partitionBy(*keys).orderBy(*_newest_first(order + ties))
    return (
        df.withColumn("_place", F.row_number().over(newest))
        .filter(F.col("_place") == 1)
        .drop("_place")
    )


def latest_of_listed(
    df: DataFrame, keys: list[str], order: list[str], listed: DataFrame, by: str
) -> DataFrame:
    """As ``latest_per_key``, of the keys whose ``by``, one of their columns, stands in ``listed``.

    For a list that is too long for every executor: rows are matched with it after each key
    is down to one, so a key that repeats moves as one row per task and not with all its rows.
    """
    return latest_per_key(df, keys, order).join(listed.select(by), by, "left_semi")


def dedupe_audit(
    df: DataFrame, keys: list[str], order: list[str], measure: str
) -> DataFrame:
    """One row: rows and exact sum of ``measure`` before and after ``latest_per_key``.

    Both sides come from a single aggregation by key with map-side partials, so the
    source is read once and the reconciliation costs what the dedupe itself costs.
    ``measure`` must be an integer column.
    """
    newest = F.max_by(F.col(measure), F.struct(*order, measure))
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum(measure).alias("_sum"),
        newest.alias("_kept"),
    )
    return per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        F.coalesce(F.sum("_sum"), F.lit(0)).alias("sum_before"),
        F.coalesce(F.sum("_kept"), F.lit(0)).alias("sum_after"),
    )
