"""Readers with declared schemas: no inference job, columns and filters reach the scan."""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outagelens import vocabulary as v
from outagelens.operators.filters import in_years


CSV_STAMP = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
#: text as it is landed; a compressed file is read by one task, so its lines are bounded
TEXT_FILES = {"compression": "lz4", "maxRecordsPerFile": 250_000}


def read_events(
    spark: SparkSession, path: str | list[str], years: list[int] | None = None, extra: str = ""
) -> DataFrame:
    """Landed or stored events, of one path or several; ``years`` prunes the ``_ano_fonte`` folders of a table.

    ``extra`` declares further columns, such as the provenance of a stored table.
    """
    if years is not None and "_ano_fonte" not in extra:
        extra += ", _ano_fonte INT"
    paths = [path] if isinstance(path, str) else path
    df = spark.read.schema(v.EVENT_SCHEMA + extra).parquet(*paths)
    return in_years(df, "_ano_fonte", years) if years is not None else df


def read_indicators(
    spark: SparkSession, path: str, years: list[int] | None = None, extra: str = ""
) -> DataFrame:
    """Landed or stored indicator series; ``years`` is pushed to the scan."""
    df = spark.read.schema(v.INDICATOR_SCHEMA + extra).parquet(path)
    return in_years(df, "anoindice", years) if years is not None else df


def read_year_list(spark: SparkSession, view: str, column: str, years: list[int]) -> DataFrame:
    """SQL scan restricted to a list of years.

    Names and years are bound as parameters, never spliced into the text; the optimizer
    sees a literal list, which reaches the scan.
    """
    if not years:
        raise ValueError("no years to process")
    marks = ", ".join(f":y{i}" for i in range(len(years)))
    return spark.sql(
        f"SELECT * FROM IDENTIFIER(:view) WHERE IDENTIFIER(:column) IN ({marks})",
        args={"view": view, "column": column, **{f"y{i}": y for i, y in enumerate(years)}},
    )


def read_csv_landing(
    spark: SparkSession, path: str, schema: str, sep: str = ",", encoding: str = "UTF-8"
) -> DataFrame:
    """A folder of delimited files with header rows, blanks kept as delivered."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", CSV_STAMP)
        .csv(path)
    )


#: the line of a row that does not fit its schema; null in rows that do
RAW_LINE = "_linha"


def read_csv_checked(
    spark: SparkSession, path: str | list[str], schema: str, sep: str = ",", encoding: str = "UTF-8", header: bool = True,
    escape: str = '"',
) -> DataFrame:
    """Delimited files with every line kept: those that don't fit carry ``RAW_LINE``.

    A line with too few or too many fields, or with a field that is no value of its type,
    holds what could be read and the line itself. With a header its names must be those of
    the schema, or reading fails. Quotes inside quotes are doubled, or follow another
    ``escape``.

    Spark reads as their types only the columns that a query uses. A condition that always
    holds uses them all, so the same lines are found whatever a query asks for.
    """
    every = F.xxhash64(*T.StructType.fromDDL(schema).names) >= F.lit(-(2**63))
    return (
        spark.read.schema(f"{schema}, {RAW_LINE} STRING")
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW_LINE)
        .option("header", header).option("enforceSchema", False).option("columnPruning", False)
        .option("sep", sep).option("encoding", encoding).option("escape", escape)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", CSV_STAMP)
        .csv(path)
        .filter(every)
    )


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(RAW_LINE).isNull()).drop(RAW_LINE)


def judged(rows: DataFrame, schema: str, sep: str = ",", escape: str = '"') -> DataFrame:
    """All rows with ``motivo``: null where they fit ``schema``, else why they don't.

    ``motivo`` is worked out for lines that don't fit only: ``campos`` for a wrong number of
    fields, else ``tipo:`` and the columns whose text is no value of their type. Both kinds
    of rows come from one read, where ``accepted`` beside ``rejected`` takes two.
    """
    fields = T.StructType.fromDDL(schema).fields
    faulty = F.col(RAW_LINE).isNotNull()
    as_text = F.from_csv(
        F.col(RAW_LINE), ", ".join(f"`{f.name}` STRING" for f in fields) + ", _errado STRING",
        {"sep": sep, "escape": escape, "columnNameOfCorruptRecord": "_errado", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    wrong = [
        F.when(F.col("_texto")[f.name].isNotNull() & F.col("_texto")[f.name].try_cast(f.dataType).isNull(), f.name)
        for f in fields
    ]
    reason = F.when(F.col("_texto")["_errado"].isNotNull(), "campos").otherwise(
        F.concat_ws(" ", F.lit("tipo:"), F.concat_ws(", ", *wrong)))
    return rows.withColumn("_texto", F.when(faulty, as_text)).withColumn("motivo", F.when(faulty, reason)).drop("_texto")


def rejected(rows: DataFrame, schema: str, sep: str = ",", escape: str = '"') -> DataFrame:
    """Lines that don't fit ``schema``: its other columns, linha, lido and motivo.

    ``lido`` is what could be read, as JSON; ``motivo`` as ``judged`` tells it.
    """
    names = T.StructType.fromDDL(schema).names
    others = [c for c in rows.columns if c not in names and c != RAW_LINE]
    bad = judged(rows.filter(F.col(RAW_LINE).isNotNull()), schema, sep, escape)
    return bad.select(*others, F.col(RAW_LINE).alias("linha"), F.to_json(F.struct(*names)).alias("lido"), "motivo")


def _common_type(spark: SparkSession, types: list[T.DataType]) -> T.DataType:
    """The type that Spark itself gives a column that holds all of these."""
    empty = spark.range(0).select(F.coalesce(*[F.lit(None).cast(t) for t in types]).alias("c"))
    return empty.schema["c"].dataType


def read_reconciled(
    spark: SparkSession, deliveries: list[str], wanted: dict[str, str] | None = None
) -> DataFrame:
    """Deliveries whose columns changed type as one table, each value in the widest type.

    A delivery is a file, or a folder written at once, so one footer tells its schema; those
    with equal schemas are scanned together. A column gets the type that Spark widens its
    types to (int to long, date to timestamp), or the one ``wanted`` names for it, to which
    text is converted too. Columns that a delivery lacks are null in its rows.

    ``_falhas_conversao`` counts a row's values that are no value of that type and became
    null; everything else of the row stays.
    """
    by_schema: dict[str, tuple[T.StructType, list[str]]] = {}
    for path in deliveries:
        schema = spark.read.parquet(path).schema
        by_schema.setdefault(schema.json(), (schema, []))[1].append(path)
    types: dict[str, list[T.DataType]] = {}
    for schema, _ in by_schema.values():
        for field in schema:
            types.setdefault(field.name, []).append(field.dataType)
    target = {n: (wanted or {}).get(n) or _common_type(spark, of) for n, of in types.items()}

    def conformed(schema: T.StructType, paths: list[str]) -> DataFrame:
        have = set(schema.names)
        columns = {n: F.col(n).try_cast(t) if n in have else F.lit(None).cast(t) for n, t in target.items()}
        failed = [F.when(F.col(n).isNotNull() & columns[n].isNull(), 1).otherwise(0) for n in target if n in have]
        return spark.read.schema(schema).parquet(*paths).select(
            *[c.alias(n) for n, c in columns.items()], functools.reduce(lambda a, b: a + b, failed).alias("_falhas_conversao"))

    return functools.reduce(DataFrame.unionByName, [conformed(*group) for group in by_schema.values()])


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """A table whose files gained columns over time: the union of all, older rows null."""
    return spark.read.option("mergeSchema", True).parquet(path)


def union_evolving(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both, columns of either."""
    return old.unionByName(new, allowMissingColumns=True)


def table_or_skip(
    spark: SparkSession, name: str, run_ts: dt.datetime | None = None
) -> tuple[DataFrame | None, str]:
    """A catalog table, or none and a status saying why it was skipped."""
    if not spark.catalog.tableExists(name):
        return None, f"SKIPPED - {name} not found"
    return spark.table(name), "OK"


def stamp(
    df: DataFrame,
    style: str,
    source_url: str | Column,
    run_ts: dt.datetime,
    last_modified: str | Column = "",
    year: int | Column | None = None,
) -> DataFrame:
    """Add provenance columns; one run stamp for all rows, given by the caller.

    URL, version and year are values, or columns if rows of several files stand together.

    Style ``source`` names url, version and year of the file; ``run`` names the run;
    ``file`` names the file only.
    """
    run = F.lit(run_ts).cast("timestamp")
    styles = {
        "source": {
            "_ingest_timestamp": run,
            "_source_url": F.lit(source_url),
            "_source_last_modified": F.lit(last_modified),
            "_ano_fonte": F.lit(year).cast("int"),
        },
        "run": {
            "_fonte_url": F.lit(source_url),
            "_ingest_ts": run,
            "_ingest_date": F.to_date(run),
            "_run_id": F.lit(run_ts.strftime("%Y%m%d%H%M%S")),
        },
        "file": {
            "_data_ingestao": run,
            "_arquivo_fonte": F.lit(source_url),
            "_ano_referencia": F.lit(year).cast("int"),
        },
    }
    return df.withColumns(styles[style])
