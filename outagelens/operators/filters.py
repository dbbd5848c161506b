"""Row rules, written so that a missing value is handled explicitly."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outagelens import vocabulary as v
from outagelens.functions import durations, text

START, END = "DatInicioInterrupcao", "DatFimInterrupcao"


def reversed_or_empty(start: str = START, end: str = END) -> Column:
    """Both stamps known and the end not after the start; never null."""
    return F.coalesce(F.col(end) <= F.col(start), F.lit(False))


def temporal_invalid(df: DataFrame, start: str = START, end: str = END) -> DataFrame:
    return df.filter(F.col(end) <= F.col(start))


def temporal_valid(df: DataFrame, start: str = START, end: str = END) -> DataFrame:
    """Keeps open events and events of unknown start; drops only proven contradictions."""
    return df.filter(~reversed_or_empty(start, end))


def long_outages(df: DataFrame, start: str = START, end: str = END, minutes: float = v.LONG_MIN_MINUTES) -> DataFrame:
    return df.filter(durations.elapsed_seconds(start, end) > int(minutes * 60))


def quality_filter(
    df: DataFrame,
    consumers: str = "NumUnidadeConsumidora",
    volts: str = "NumNivelTensao",
    start: str = START,
    end: str = END,
) -> DataFrame:
    """Closed events of positive length with consumers affected and a voltage level."""
    return df.filter(
        (F.col(consumers) > 0) & (F.col(end) > F.col(start)) & (F.col(volts) != 0)
    )


def dec_event_filter(
    df: DataFrame,
    include: list[str] | None = None,
    exclude: list[str] | None = None,
    min_minutes: float = v.MIN_MINUTES,
    min_consumers: int = v.MIN_CONSUMERS,
    kind: str = "DscTipoInterrupcao",
    consumers: str = "NumUnidadeConsumidora",
    start: str = START,
    end: str = END,
) -> DataFrame:
    """Events that count towards a continuity index.

    Type labels are compared trimmed, in lower case and without accents. With an
    ``include`` list an unknown type is out; with ``exclude`` alone it stays in.
    """
    label = text.folded(F.col(kind))
    kept = (durations.elapsed_seconds(start, end) >= int(min_minutes * 60)) & (
        F.col(consumers) >= min_consumers
    )
    if include:
        kept = kept & label.isin([text.fold_literal(t) for t in include])
    if exclude:
        banned = label.isin([text.fold_literal(t) for t in exclude])
        kept = kept & ~F.coalesce(banned, F.lit(False))
    return df.filter(kept)


def in_years(df: DataFrame, column: str, years: list[int]) -> DataFrame:
    """Rows of the given years; on a partition column only those folders are listed."""
    if not years:
        raise ValueError("no years to process")
    return df.filter(F.col(column).isin(years))


def parse_years(text_list: str | None, default: str = "2025") -> list[int]:
    """``"2023, 2024"`` to ``[2023, 2024]``."""
    years = [int(part) for part in (text_list or default).split(",") if part.strip()]
    if not years:
        raise ValueError("no years to process")
    return years


def drop_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def null_drops(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that each column takes out in ``drop_nulls``, in the order given: one pass.

    A row that lacks several is counted with the first of them, so the numbers add up to the
    rows removed.
    """
    names = [F.when(F.col(c).isNull(), F.lit(i)) for i, c in enumerate(columns)]
    first = F.coalesce(*names)
    totals = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(first == i).alias(f"_{i}") for i in range(len(columns))])
    left, entries = F.col("_rows"), []
    for i, c in enumerate(columns):
        left = left - F.col(f"_{i}")
        entries.append(F.struct(F.lit(c).alias("coluna"), F.col(f"_{i}").alias("removidas"), left.alias("restantes")))
    return totals.select(F.inline(F.array(*entries)))


def out_of_domain(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Rows whose known value is not allowed; a null is a completeness matter, not this one."""
    return df.filter(~F.col(column).isin(allowed))


def containing(df: DataFrame, column: str, part: str) -> DataFrame:
    return df.filter(F.col(column).contains(part))


def any_present(columns: list[str]) -> Column:
    """At least one of the columns is known."""
    return reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in columns])
