"""Calendar fields and month arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(year: Column, month: Column) -> Column:
    """First day of the month; null unless the month is 1-12 and the year is known."""
    year, month = year.cast("int"), month.cast("int")
    return F.when(month.between(1, 12), F.make_date(year, month, F.lit(1)))


def year_start(year: Column) -> Column:
    return F.make_date(year.cast("int"), F.lit(1), F.lit(1))


def month_number(year: Column, month: Column) -> Column:
    """Months since year zero, so that neighbours differ by one across a year end."""
    return year.cast("int") * 12 + month.cast("int")


def stamp_instant(stamp: Column) -> Column:
    """The instant that a version stamp names, as an HTTP date or as a timestamp in text;
    null for any other text."""
    parts = [F.regexp_extract(stamp, r"(\d{1,2})[ -]([A-Za-z]{3})[ -](\d{4}) (\d{2}:\d{2}:\d{2})", k) for k in range(1, 5)]
    months = F.lit("janfebmaraprmayjunjulaugsepoctnovdec")
    month = F.floor((F.position(F.lower(parts[1]), months) + 2) / 3)
    text = F.concat(parts[2], F.lit("-"), F.lpad(month.cast("string"), 2, "0"), F.lit("-"),
                    F.lpad(parts[0], 2, "0"), F.lit(" "), parts[3], F.lit("Z"))
    return F.coalesce(text.try_cast("timestamp"), F.trim(stamp).try_cast("timestamp"))


def calendar_fields(stamp: str) -> dict[str, Column]:
    """Date, month, weekday (1 = Sunday) and hour of the start of an event."""
    value = F.col(stamp)
    return {
        "data_interrupcao": F.to_date(value),
        "mes_interrupcao": F.month(value),
        "dia_semana_interrupcao": F.dayofweek(value),
        "hora_inicio_interrupcao": F.hour(value),
    }
