"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemscope.llm.common import saved


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node reachable, for every node that has a link.

    Distributed union-find by alternating stars. In a large star every node
    hands its greater neighbours over to its smallest neighbour; in a small star
    every node hangs itself and its smaller neighbours under the smallest. Both
    keep components whole, and the links end as stars around the roots, after a
    number of rounds that grows with the logarithm of the longest chain. A
    round groups with map-side minima and joins, so a hub's neighbours are never
    collected; every round is written to the shared folder.

    Links with a null end and links of a node to itself count for nothing.
    """
    low, high = F.least(a, b).alias("low"), F.greatest(a, b).alias("high")
    edges = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(low, high).distinct()
    edges = saved(edges, "links")
    mark = _mark(edges)
    while True:
        edges = saved(_small_star(_large_star(edges)), "stars")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    members = edges.select(F.col("high").alias("node"), F.col("low").alias("root"))
    return members.unionByName(edges.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct())


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal sets of links."""
    h = F.xxhash64("low", "high")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("low").alias("u"), F.col("high").alias("v")).unionAll(
        edges.select(F.col("high").alias("u"), F.col("low").alias("v")))
    least = both.groupBy(F.col("u").alias("n")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter("v > u").join(least, F.col("u") == F.col("n")).select(F.col("m").alias("low"), F.col("v").alias("high"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("high").alias("n")).agg(F.min("low").alias("m"))
    joined = edges.join(least, F.col("high") == F.col("n"))
    moved = joined.filter("low <> m").select(F.col("m").alias("low"), F.col("low").alias("high"))
    return moved.unionAll(least.select(F.col("m").alias("low"), F.col("n").alias("high"))).distinct()
