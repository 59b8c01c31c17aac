"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.scratch import written


def least_neighbours(ends: DataFrame) -> DataFrame:
    return ends.groupBy("u").agg(F.min("v").alias("low"))


def large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to its least neighbour (or itself)."""
    ends = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lows = least_neighbours(ends).withColumn("low", F.least("low", "u"))
    moved = ends.join(lows, "u").filter(F.col("v") > F.col("u"))
    return moved.select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, move to the least of them."""
    lows = least_neighbours(links)
    others = links.join(lows, "u").filter(F.col("v") != F.col("low")).select(F.col("v").alias("u"), F.col("low").alias("v"))
    return others.unionByName(lows.select("u", F.col("low").alias("v"))).distinct()


def state(links: DataFrame) -> tuple[int, int]:
    """Number of links and a checksum of them."""
    row = links.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))).first()
    return row[0], int(row[1])


def components(pairs: DataFrame) -> DataFrame:
    """``node, component`` (its smallest member) for every node of the pairs (a, b).

    Each step is a table in the shared folder. A node's links are reduced to one
    minimum before they are shuffled, and joins on a node with very many links are
    between one row and many, which adaptive execution splits.
    """
    a, b = pairs.columns[:2]
    links = pairs.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    links = written(links, "links")
    before = state(links)
    while before[0]:
        links = written(small_star(large_star(links)), "stars")
        after = state(links)
        if after == before:
            break
        before = after
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
