"""Session conventions: UTC clock and the shared folder for written tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def pin_utc(spark: SparkSession) -> SparkSession:
    """Local event times carry no zone; reading them in UTC keeps every hour 3600 s long."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, else one in the warehouse.

    The warehouse holds the cluster's tables, so every executor reaches it too; a folder of
    one machine would be lost with it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_written"


def table_path(spark: SparkSession, name: str) -> str:
    """A path no other run writes to."""
    return f"{shared_dir(spark)}/outagelens/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go as it ends, not when the driver next collects garbage.

    For writes, whose shuffles nothing reads again. The setting is put back after.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@contextmanager
def reused(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a table over several analyses and release it after.

    Blocks lost with an executor are computed again from the source. For one analysis, or
    for results larger than the cluster's storage, write a table instead.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
