"""Elapsed time between two event stamps, and the labels derived from it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from outagelens import vocabulary as v

UNIT_SECONDS = {"seconds": 1, "minutes": 60, "hours": 3600}
_UNIT_KEYWORD = {"seconds": "SECOND", "minutes": "MINUTE", "hours": "HOUR"}


def elapsed_seconds(start: str, end: str) -> Column:
    """Whole seconds from start to end; null when either is missing, negative when reversed."""
    return F.unix_timestamp(F.col(end)) - F.unix_timestamp(F.col(start))


def elapsed(
    start: str,
    end: str,
    unit: str = "minutes",
    null_as_zero: bool = False,
    whole_units: bool = False,
    digits: int | None = None,
) -> Column:
    """Elapsed time in ``unit``.

    ``whole_units`` counts complete units (a fraction is cut off, result is a bigint);
    otherwise the result is a double except for seconds. ``null_as_zero`` gives an open
    event the duration zero; ``digits`` rounds.
    """
    if whole_units:
        value, zero = F.timestamp_diff(_UNIT_KEYWORD[unit], F.col(start), F.col(end)), F.lit(0)
    else:
        seconds = elapsed_seconds(start, end)
        if unit == "seconds":
            value, zero = seconds, F.lit(0)
        else:
            value, zero = seconds / F.lit(float(UNIT_SECONDS[unit])), F.lit(0.0)
    if digits is not None:
        value = F.round(value, digits)
    return F.coalesce(value, zero) if null_as_zero else value


def exact_seconds(minutes: Column) -> Column:
    """Minutes held as a double, back to the whole seconds they came from.

    Sums of these integers do not depend on the order rows arrive in, unlike sums of
    doubles, so totals are repeatable and reconcile exactly.
    """
    return F.rint(minutes * F.lit(60.0)).cast("bigint")


def duration_class(
    minutes: Column,
    short_max: float = v.SHORT_MAX_MINUTES,
    long_min: float = v.LONG_MIN_MINUTES,
) -> Column:
    return (
        F.when(minutes.isNull(), v.CLASS_NONE)
        .when(minutes >= long_min, v.CLASS_LONG)
        .when(minutes <= short_max, v.CLASS_SHORT)
        .otherwise(v.CLASS_MEDIUM)
    )


def duration_flag(start: str, end: str) -> Column:
    """Label by complete days; an open event is normal."""
    days = F.timestamp_diff("DAY", F.col(start), F.col(end))
    return (
        F.when(days > v.FLAG_EXTREME_DAYS, v.FLAG_EXTREME)
        .when(days >= v.FLAG_LONG_DAYS, v.FLAG_LONG)
        .otherwise(v.FLAG_NORMAL)
    )


def duration_band(start: str, end: str) -> Column:
    """Band for reports; null for an open event.

    Up to and including 24 hours, then by complete days as the flag counts them.
    """
    seconds = elapsed_seconds(start, end)
    days = F.timestamp_diff("DAY", F.col(start), F.col(end))
    return (
        F.when(seconds <= 86400, v.BAND_DAY)
        .when(days < v.FLAG_LONG_DAYS, v.BAND_WEEK)
        .when(days <= v.FLAG_EXTREME_DAYS, v.BAND_MONTH)
        .when(days > v.FLAG_EXTREME_DAYS, v.BAND_OVER)
    )
