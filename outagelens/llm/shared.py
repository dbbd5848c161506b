"""Written steps: lineage is cut in the folder that all executors share."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outagelens import session


def stored(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed once and kept as a checkpoint in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{session.shared_dir(spark)}/llm-{uuid.uuid4().hex}")
    return df.checkpoint()


#: a filter holds 16 bits for each member, up to so many bits in all (16 MB)
_MOST_BITS = 1 << 27


def member_bits(members: DataFrame, id_col: str) -> np.ndarray:
    """A bitmap of hashed ids, of bounded size, that tells most of what is no member.

    Rows that it lets pass still have to be joined with the members. With more members than
    its bound provides for it lets more rows pass, up to all.
    """
    bits = min(_MOST_BITS, 1 << max(6, (16 * members.count()).bit_length()))
    place = F.pmod(F.xxhash64(id_col), F.lit(bits))
    words = (
        members.select(place.alias("place"))
        .select(F.shiftright("place", 6).alias("word"), F.expr("shiftleft(1L, cast(place & 63 as int))").alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    )
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def member_place(id_col: str, bitmap: np.ndarray) -> Column:
    """Where an id stands in the bitmap."""
    return F.pmod(F.xxhash64(id_col), F.lit(len(bitmap) * 64))


def may_be_member(places: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    return (bitmap[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1) == 1
