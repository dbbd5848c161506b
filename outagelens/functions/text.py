"""Text and number formatting expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: accented letters of the source language and their plain forms
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçñÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑ"
PLAIN = "aaaaaeeeeiiiiooooouuuucnAAAAAEEEEIIIIOOOOOUUUUCN"


def folded(text: Column) -> Column:
    """Trimmed, lower case, without accents: the form labels are compared in."""
    return F.lower(F.translate(F.trim(text), ACCENTED, PLAIN))


def fold_literal(text: str) -> str:
    """The same folding for a literal known on the driver."""
    decomposed = unicodedata.normalize("NFD", text.strip().lower())
    return "".join(ch for ch in decomposed if not unicodedata.combining(ch))


def blank(text: Column) -> Column:
    """Present but empty once trimmed."""
    return text.isNotNull() & (F.trim(text) == F.lit(""))


def cause_level(cause: Column, level: int) -> Column:
    """Level 1-4 of a hierarchical cause whose parts are separated by ``;`` or ``-``.

    A level that is missing or empty is null; parts after the fourth are ignored.
    """
    part = F.trim(F.get(F.split(cause, "[;-]"), level - 1))
    return F.nullif(part, F.lit(""))


def cnpj_text(number: Column) -> Column:
    """A registration number with its leading zeros back, 14 digits."""
    return F.lpad(number.cast("string"), 14, "0")


def kilovolts(volts: Column) -> Column:
    return F.round(volts / F.lit(1000.0), 3)


def composite_key(*parts: Column) -> Column:
    """Key text; a missing part keeps its place so that keys of different rows differ."""
    return F.concat_ws("#", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def share(part: Column, total: Column) -> Column:
    """Percentage with two decimals, rounded half up in integers; null for an empty total."""
    hundredths = F.call_function("div", part * 20000 + total, F.nullif(total * 2, F.lit(0)))
    return hundredths / F.lit(100.0)
