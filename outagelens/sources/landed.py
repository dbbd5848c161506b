"""Landed files as one table: which file each row came from, and which files can be read."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: where a row's file stands while it is matched with the manifest
FILE_PATH = "_file_path"


def with_file_path(rows: DataFrame) -> DataFrame:
    return rows.select("*", F.col("_metadata.file_path").alias(FILE_PATH))


def _plain(uri: str) -> str:
    """One spelling of a path: escapes resolved, one slash after the scheme, none at the end."""
    return re.sub(r"^([A-Za-z][\w+.-]*):/+", r"\1:/", unquote(uri)).rstrip("/")


def _qualified(spark: SparkSession, url: str) -> str:
    """A manifest's URL as the file system names it: with scheme, relative to its home."""
    path = spark._jvm.org.apache.hadoop.fs.Path(url)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return _plain(system.makeQualified(path).toUri().toString())


def owners(spark: SparkSession, urls: Sequence[str], files: Sequence[str]) -> dict[str, list[int]]:
    """Per file, the places in ``urls`` of the one that names it or the nearest folder above."""
    named: dict[str, list[int]] = {}
    for place, url in enumerate(urls):
        named.setdefault(_qualified(spark, url), []).append(place)
    found = {}
    for file in files:
        above = _plain(file)
        while above and above not in named:
            above = above.rpartition("/")[0]
        found[file] = named.get(above, [])
    return found


def with_owner(rows: DataFrame, files: list[dict]) -> DataFrame:
    """Rows with the columns that ``files`` holds beside ``FILE_PATH``, matched by it.

    ``files`` has one entry per landed file, so its size is the manifest's; whether it is
    broadcast is left to its measured size.
    """
    listed = rows.sparkSession.createDataFrame(pa.Table.from_pylist(files))
    return rows.join(listed, FILE_PATH).drop(FILE_PATH)


def by_halves(items: list, attempt: Callable[[list], dict]) -> tuple[dict, dict[int, str]]:
    """Results of ``attempt`` for all (place, item) at once, and the failures by place.

    One that fails makes the whole attempt fail; then both halves are tried for themselves,
    until each failure stands alone with its own message. Without failures there is one
    attempt, with f of n failing about 2 f log n.
    """
    if not items:
        return {}, {}
    try:
        return attempt(items), {}
    except Exception as failure:
        if len(items) == 1:
            return {}, {items[0][0]: str(failure)}
    middle = len(items) // 2
    (done, failed), (more, others) = by_halves(items[:middle], attempt), by_halves(items[middle:], attempt)
    return done | more, failed | others
