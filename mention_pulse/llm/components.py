"""Connected components of a table of links, by rounds of joins and minima.

Every round each node's smallest known neighbour replaces larger ones: links of a node to larger nodes
are moved to its smallest neighbour (large step), then all its links to smaller nodes to the smallest of
them (small step), until nothing moves. Rounds grow with the logarithm of the longest chain. Each round
is written to the shared folder of spark.checkpoint.dir, so it outlives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROUNDS = 60


def _large(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("u", "low"))
    moved = both.filter("v > u").join(least, "u")
    return moved.select(F.col("v").alias("u"), F.col("low").alias("v")).filter("u != v").distinct()


def _small(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("low"))
    moved = links.join(least, "u")
    lower = moved.filter("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return lower.union(least.select("u", F.col("low").alias("v"))).filter("u != v").distinct()


def components(links: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """(node, component) for every node with a link; component is the smallest node it reaches.

    Links are undirected; nulls and links of a node to itself are passed over; an empty table gives
    an empty one.
    """
    links = (
        links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .filter(F.col("u") != F.col("v"))
        .distinct()
        .checkpoint()
    )
    mark = None
    for _ in range(MAX_ROUNDS):
        links = _small(_large(links)).checkpoint()
        # a fixed point: every node points at its smallest, none of which has a smaller one
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("links are still moving")
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    heads = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.union(heads)
