"""Sketch states kept per year: merged when asked, replaced with their year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2**LG_K registers: a relative standard error of 1.04 / sqrt(2**LG_K) for distinct counts
LG_K = 12
#: size of a quantile state: a rank error of at most about 1.7 % in 99 of 100 cases
KLL_K = 200
STATES = "linhas BIGINT, distintos BINARY, quantis BINARY"


def year_states(df: DataFrame, year_col: str, member: Column, value: Column) -> DataFrame:
    """One row per year: rows, the state of distinct ``member`` and that of the bigint ``value``.

    States are filled in the map tasks and merged per year, so a year that holds a third of
    all rows sends one state of a few kilobytes per task. Nulls enter neither state.
    """
    return df.groupBy(year_col).agg(
        F.count(F.lit(1)).alias("linhas"),
        F.hll_sketch_agg(member, LG_K).alias("distintos"),
        F.kll_sketch_agg_bigint(value, KLL_K).alias("quantis"),
    )


def distinct_from_states(states: DataFrame) -> DataFrame:
    """The number of distinct members over all years at hand, from their states only."""
    return states.agg(F.hll_sketch_estimate(F.hll_union_agg("distintos")).alias("total"))


def quantiles_from_states(states: DataFrame, shares: dict[str, float]) -> DataFrame:
    """Named quantiles of the values of all years at hand, from their states only."""
    merged = states.agg(F.kll_merge_agg_bigint("quantis").alias("q"))
    return merged.select(*[
        F.kll_sketch_get_quantile_bigint("q", F.lit(share)).alias(name) for name, share in shares.items()])


def quantile_check(df: DataFrame, value: Column, quantiles: DataFrame, shares: dict[str, float], rank_error: float) -> DataFrame:
    """Per quantile the values on record and whether its true rank lies within the error.

    A quantile stands for the ranks of all values equal to it, so the share below it must not
    exceed, nor the share up to it fall short of, the one asked for by more than the error.
    """
    found = quantiles.agg(F.struct(*[F.first(n).alias(n) for n in shares])).scalar()
    counts = [F.count(value).alias("n")]
    for name in shares:
        counts += [F.count_if(value < found.getField(name)).alias(f"below_{name}"),
                   F.count_if(value <= found.getField(name)).alias(f"upto_{name}")]
    totals = df.agg(*counts)
    return totals.select(F.inline(F.array(*[
        F.struct(
            F.lit(name).alias("quantil"), F.col("n").alias("valores"),
            ((F.col(f"below_{name}") <= (share + rank_error) * F.col("n"))
             & (F.col(f"upto_{name}") >= (share - rank_error) * F.col("n"))).alias("within_bound"))
        for name, share in shares.items()])))
