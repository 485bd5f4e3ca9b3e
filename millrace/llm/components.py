"""Connected components by alternating large and small stars over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .scratch import scratch


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """edges as a written table, and their number and a sum of hashes, taken while they are written."""
    seen = Observation()
    table = scratch(edges.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("hashes")), "edges")
    return table, (seen.get["n"], seen.get["hashes"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    others = edges.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return others.unionByName(low.select("a", F.col("low").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """node and component (the smallest node reachable) of every linked node but the smallest itself.

    links: a and b, longs without null; any order, repeats allowed; a link of a node to itself is void.
    """
    edges, seen = _written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while seen[0]:
        edges, now = _written(_small_star(_large_star(edges)))
        if now == seen:
            break
        seen = now
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
