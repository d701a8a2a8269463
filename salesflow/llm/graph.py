"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.sources.workspace import saved


def _nearest(edges: DataFrame) -> DataFrame:
    """For each u its smallest neighbour; combined before the shuffle, so a hub is a few rows."""
    return edges.groupBy("u").agg(F.min("v").alias("low"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of u to the smallest node around u."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _nearest(both).withColumn("low", F.least("u", "low"))
    return (
        both.join(low, "u")
        .filter(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("low").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link u and its smaller neighbours to the smallest of them; every edge has u > v."""
    low = _nearest(edges)
    moved = (
        edges.join(low, "u")
        .filter(F.col("v") > F.col("low"))
        .select(F.col("v").alias("u"), F.col("low").alias("v"))
    )
    return moved.unionByName(low.withColumnRenamed("low", "v")).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of the links (a, b), root being the component's smallest node.

    The number of rounds grows with the logarithm of the longest chain. Each round is a written
    table, so a lost executor costs one round at most. Links with a NULL end are ignored; an
    empty table gives an empty one. Nothing but a count and a checksum reaches the driver.
    """
    edges = saved(
        links.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    mark = _mark(edges)
    while mark[0]:
        edges = saved(_small_star(_large_star(edges)), "stars")
        before, mark = mark, _mark(edges)
        if before == mark:
            break
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return members.unionByName(roots)
