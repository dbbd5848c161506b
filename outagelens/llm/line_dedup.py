"""Repeated passages: windows of three consecutive lines that occur elsewhere before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 3
#: ids times this plus the line number order all places of a corpus
_LINES = 2**31


def _place(doc: Column, line: Column) -> Column:
    doc = F.coalesce(doc.cast("decimal(20,0)"), F.lit(str(2**63)).cast("decimal(20,0)"))
    return (doc * F.lit(_LINES).cast("decimal(11,0)") + line).cast("decimal(38,0)")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with later occurrences of repeated three-line windows cut out of the text.

    Every window of three consecutive lines is hashed to 128 bits. Where a hash occurs more
    than once, the place with the smallest (id, line number) stays; the lines that any later
    window covers are removed, overlapping windows merged. Adds ``n_lines`` and
    ``n_removed`` (long).

    A window that very many documents hold is reduced in the map tasks to its first place;
    the join that finds later places has one row per hash on its other side, so adaptive
    execution can split a hot hash. Text moves once, to meet the lines its document loses.

    Defined results: a null text has no lines and stays null; an empty text has one empty
    line. Windows of blank lines only are never repeats. Documents of fewer than three lines
    have no window and stay. A null id comes after all others. Rows that share an id are
    versions of one document: the same window at the same line is not a later one. All
    columns stay, whatever their names; ``n_lines`` and ``n_removed`` replace columns of
    that name.
    """
    lines = F.split(F.col(text_col), "\n", -1)
    size = F.size(lines)
    keyed = docs.select(F.col(id_col).alias("id"), F.md5(text_col).alias("version"), lines.alias("lines"))
    count = F.size("lines") - (WINDOW - 1)
    shifted = [F.slice("lines", i + 1, F.greatest(count, F.lit(0))) for i in range(WINDOW)]
    windows = (
        keyed.filter(F.size("lines") >= WINDOW)
        .select("id", "version", F.posexplode(F.arrays_zip(*shifted)).alias("line", "window"))
        .select("id", "version", "line", F.concat_ws("\n", *[F.col(f"window.{i}") for i in range(WINDOW)]).alias("body"))
        .filter(F.length(F.trim("body", F.lit(" \t\r\n"))) > 0)
        .select("id", "version", "line", F.unhex(F.md5("body")).alias("hash"), _place(F.col("id"), F.col("line")).alias("place"))
    )
    first = (
        windows.groupBy("hash").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1").select("hash", "first")
    )
    covered = (
        windows.join(first, "hash").filter("place > first")
        .select("id", "version", F.explode(F.array(*[F.col("line") + i for i in range(WINDOW)])).alias("line"))
        .groupBy("id", "version").agg(F.collect_set("line").alias("covered"))
    )
    kept_lines = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept_lines]).alias("row"),
                       F.col(id_col).alias("own_id"), F.md5(text_col).alias("own_version"))
    joined = rows.join(
        covered, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_version") == F.col("version")), "left"
    )
    lines = F.split(F.col("row")[text_col], "\n", -1)
    size = F.coalesce(F.when(F.col("row")[text_col].isNotNull(), F.size(lines)), F.lit(0)).cast("long")
    # binding the lines to a lambda variable splits the text once, not once a line
    rest = F.transform(F.array(lines), lambda all_lines: F.array_join(
        F.transform(
            F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("covered")),
            lambda i: F.element_at(all_lines, i + 1),
        ), "\n"))[0]
    text = F.when(F.col("covered").isNull(), F.col("row")[text_col]).otherwise(rest)
    others = [c for c in kept_lines if c not in ("n_lines", "n_removed")]
    return joined.select(
        *[text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in others],
        size.alias("n_lines"),
        F.coalesce(F.size("covered"), F.lit(0)).cast("long").alias("n_removed"),
    )
