"""Connected components of a table of links, by repeated joins to smaller neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outagelens.llm.shared import stored


#: links that one task of a round holds, about
_LINKS_PER_TASK = 250_000


def _lowest(links: DataFrame) -> DataFrame:
    """(low, high) once each, without loops."""
    return (
        links.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
        .filter("low < high").distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that ``links`` (a, b: long) names in a link.

    ``component`` is the smallest node that links reach. Each round ties the larger
    neighbours of a node to its smallest one, then every node and its smaller neighbours to
    the smallest of them, until nothing changes: the links are then a star around each
    smallest node. The rounds needed grow with the logarithm of the longest path. A star
    around one node that a third of all links touch is reduced in the map tasks; nothing but
    two numbers per round reaches the driver. Links are few beside the rows they come from,
    so each step runs in as many tasks as their count asks for, and leaves as many files.

    Defined results: links with a null end and loops name no node; no links, no rows.
    """
    edges = stored(_lowest(links.filter("a is not null and b is not null")))
    before = None
    tasks = edges.count() // _LINKS_PER_TASK + 1
    while True:
        edges = edges.coalesce(tasks)
        both = edges.select(F.col("low").alias("node"), F.col("high").alias("other")).union(
            edges.select("high", "low"))
        least = both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("m"))
        large = (
            edges.join(least.withColumnRenamed("node", "low"), "low")
            .select(F.col("m").alias("a"), F.col("high").alias("b"))
        )
        edges_large = _lowest(large.coalesce(tasks)).coalesce(tasks)
        smallest = edges_large.groupBy("high").agg(F.min("low").alias("m"))
        tied = edges_large.join(smallest, "high")
        small = tied.select(F.col("m").alias("a"), F.col("low").alias("b")).union(tied.select("m", "high"))
        edges = stored(_lowest(small.coalesce(tasks)).coalesce(tasks))
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("high").alias("node"), F.col("low").alias("component")).union(
        edges.select("low", "low").distinct())
