"""Column renaming. Only metadata changes: one projection, no job."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from outagelens.functions.text import fold_literal


def fold_name(name: str) -> str:
    """Lower case, no accents, runs of other characters become one underscore."""
    return re.sub("[^a-z0-9]+", "_", fold_literal(name)).strip("_")


def snake_name(name: str) -> str:
    """As ``fold_name``, but words of a PascalCase name are separated first."""
    words = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name)
    return fold_name(words)


_MODES = {"fold": fold_name, "snake": snake_name}


def normalize_names(df: DataFrame, mode: str = "fold") -> DataFrame:
    """Rename every column except those starting with an underscore.

    Two source columns that end up with one name are an error: silently keeping both
    would leave a table whose columns cannot be told apart.
    """
    rename = _MODES[mode]
    new = [c if c.startswith("_") else rename(c) for c in df.columns]
    clashes = sorted({c for c in new if new.count(c) > 1})
    if clashes or "" in new:
        raise ValueError(f"column names collide or vanish after normalisation: {clashes}")
    return df.toDF(*new)
