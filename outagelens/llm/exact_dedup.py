"""Exact duplicates: grouped by a 128-bit content hash, bytes compared inside a group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def content_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    keep: str = "min") -> DataFrame:
    """One row per document: the id its class of equal texts keeps, and the class size.

    A class is a group of equal 128-bit hashes whose bytes are equal too: the aggregation
    key holds both, so texts that collide in the hash stay apart. Copies are reduced in the
    map tasks before texts move, so a class that holds a third of all rows arrives as one
    row per task. Rows find their class by the hash and a second, 256-bit digest; that join
    carries no text and adaptive execution splits a hot key.

    ``keep`` is ``min`` or ``max``: which id of a class stays.

    Defined results: a null text is empty. A null id is never kept while its class has
    another; a class of null ids has a null ``keep_id``. Rows that repeat id and text are
    all counted, and all are kept or dropped together. Other columns are ignored.
    """
    choose = {"min": F.min, "max": F.max}[keep]
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("body"))
    keyed = rows.select("id", "body", F.unhex(F.md5("body")).alias("hash"))
    classes = (
        keyed.groupBy("hash", "body").agg(choose("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1")
        .select("hash", F.sha2("body", 256).alias("digest"), "keep_id", "group_size")
    )
    light = rows.select("id", F.unhex(F.md5("body")).alias("hash"), F.sha2("body", 256).alias("digest"))
    keep_id = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return light.join(classes, ["hash", "digest"], "left").select(
        F.col("id").alias(id_col),
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.col("id").eqNullSafe(keep_id).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
