"""Top-k reports and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: str, k: int, ties: list[str], ascending: bool = False) -> DataFrame:
    """The ``k`` first rows by one metric, ties in name order: same rows on every run.

    Planned as one bounded heap per task and a merge of the heaps.
    """
    metric = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return df.orderBy(metric, *[F.col(c).asc_nulls_last() for c in ties]).limit(k)


def count_by(df: DataFrame, *keys: str | Column, name: str = "qtd_registros") -> DataFrame:
    """Rows per value; partial counts leave each map task, not rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def sample_n(df: DataFrame, key: list[str], n: int) -> DataFrame:
    """A repeatable sample: the first ``n`` rows by key."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in key]).limit(n)
