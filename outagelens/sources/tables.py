"""Partitioned Parquet tables: appended, replaced, or replaced by partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from outagelens.session import shuffles_dropped


def _write(
    df: DataFrame, path: str, columns: list[str], mode: str, overwrite: str = "static",
    metrics: list[Column] | None = None, sort: list[str] | None = None, placed: bool = False,
) -> Observation:
    """Write by partition columns without tying a partition to one task.

    The rebalance exchange aims at even file sizes: small partitions share a task, and a
    year that holds most of the table is split over many. Metrics are observed after it,
    in the stage that writes, where a task that is run again counts once. Rows sorted
    inside their files let later scans skip row groups by range. Rows that are ``placed``
    are not dealt again: they are scanned from files that hold a partition each, or lie in so
    few tasks for their number that each may write a file of every partition. The shuffles of
    a write go with it, so that those of several do not add up on disk.
    """
    seen = Observation()
    dealt = df if placed else df.hint("rebalance", *[F.col(c) for c in columns])
    dealt = dealt.observe(seen, *(metrics or [F.count(F.lit(1)).alias("rows")]))
    if sort:
        dealt = dealt.sortWithinPartitions(*columns, *sort)
    with shuffles_dropped(df.sparkSession):
        (
            dealt.write.mode(mode)
            .option("partitionOverwriteMode", overwrite)
            .partitionBy(*columns)
            .parquet(path)
        )
    return seen


def append(df: DataFrame, path: str, year_col: str) -> None:
    _write(df, path, [year_col], "append")


def replace_all(df: DataFrame, path: str, year_col: str, placed: bool = False) -> int:
    """The whole table anew, also when its columns changed; returns the rows written."""
    return _write(df, path, [year_col], "overwrite", placed=placed).get["rows"]


def replace_partitions(df: DataFrame, path: str, columns: list[str], placed: bool = False) -> int:
    """Replace the partitions that occur in ``df``; all others stay as they are."""
    return _write(df, path, columns, "overwrite", "dynamic", placed=placed).get["rows"]


def _write_years(
    df: DataFrame, path: str, year_col: str, years: list[int], overwrite: str, sort: list[str] | None,
    totals: dict[str, Column] | None, placed: bool,
) -> dict[int, dict[str, int]]:
    sums = {"linhas": F.lit(1), **(totals or {})}
    metrics = {
        (y, name): F.sum(F.when(F.col(year_col) == y, value)).alias(f"{name}_{y}")
        for y in years for name, value in sums.items()
    }
    seen = _write(
        df.filter(F.col(year_col).isin(years)), path, [year_col], "overwrite", overwrite,
        list(metrics.values()), sort, placed,
    )
    written = {y: {name: seen.get[f"{name}_{y}"] or 0 for name in sums} for y in years}
    bare = df.drop(year_col).limit(0)
    for year in [y for y, of in written.items() if of["linhas"] == 0]:
        bare.write.mode("overwrite").parquet(f"{path}/{year_col}={year}")
    return written


def replace_years_measured(
    df: DataFrame, path: str, year_col: str, years: list[int], sort: list[str] | None = None,
    totals: dict[str, Column] | None = None, placed: bool = False, staged: str | None = None,
) -> dict[int, dict[str, int]]:
    """Replace the given years, leave all others; returns what was written per year.

    One write for all years, and running it again gives the same table. Rows of other
    years are not written, and a listed year without rows is emptied. ``linhas`` is the
    number of rows; ``totals`` are integer expressions summed beside it in the same write.

    If ``stage_years`` has put the rows of ``df`` into the folder ``staged``, their years are
    moved from there and nothing is written or measured again.
    """
    if staged is None:
        return _write_years(df, path, year_col, years, "dynamic", sort, totals, placed)
    _move_years(df.sparkSession, staged, path, year_col, years)
    return {}


def stage_years(
    df: DataFrame, staged: str, year_col: str, years: list[int], sort: list[str] | None = None,
    totals: dict[str, Column] | None = None, placed: bool = False,
) -> dict[int, dict[str, int]]:
    """The given years to a folder from which ``replace_years_measured`` can move them.

    Whatever stood there goes. Each year has a folder, also one without rows; returns what
    was written per year.
    """
    return _write_years(df, staged, year_col, years, "static", sort, totals, placed)


def _move_years(spark: SparkSession, staged: str, path: str, year_col: str, years: list[int]) -> None:
    """Year folders to their table, one by one; a year that is no longer staged has been moved."""
    fs = spark._jvm.org.apache.hadoop.fs
    system = fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(fs.Path(path))
    for year in years:
        new, old = (fs.Path(of, f"{year_col}={year}") for of in (staged, path))
        if not system.exists(new):
            continue
        system.delete(old, True)
        if not system.rename(new, old):
            raise OSError(f"{new.toString()} could not be moved to {old.toString()}")


def replace_years(
    df: DataFrame, path: str, year_col: str, years: list[int], sort: list[str] | None = None
) -> dict[int, int]:
    """As ``replace_years_measured``; returns the rows written per year."""
    written = replace_years_measured(df, path, year_col, years, sort)
    return {year: of["linhas"] for year, of in written.items()}


def write_checked(df: DataFrame, path: str, year_col: str) -> DataFrame:
    """Write, then compare the rows that went in with those the table holds.

    The first number is observed during the write; the second is a count that reads
    only file footers.
    """
    written = replace_all(df, path, year_col)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    return stored.agg(F.count(F.lit(1)).alias("rows_in_table")).select(
        F.lit(written).cast("bigint").alias("rows_written"),
        "rows_in_table",
        (F.lit(written) == F.col("rows_in_table")).alias("matches"),
    )


def publish(spark: SparkSession, path: str, name: str, schema) -> DataFrame:
    """Give a stored table a catalog name, so that it can be read and queried by it.

    The files stay where they are; publishing again replaces the name only, and is what
    makes readers by name see partitions replaced since.
    """
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})
    return spark.catalog.createTable(name, path=path, source="parquet", schema=schema)
