"""Connected components of a graph given as a table of edges, by the smallest node of each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dormouse.llm.spread import kept


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node of an edge between two nodes.

    Every round moves the larger neighbours of each node to its smallest neighbour, then all
    neighbours of a node that are smaller to the smallest of them, until every node points at its
    component (large and small stars in turn). Aggregations have a part before their shuffle, and
    the joins back to a node with many neighbours can be split. Each round is written to the shared
    folder, and only a count and a sum come to the driver.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    pairs = kept(pairs)
    last = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.where("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        moved = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        pairs = kept(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        # Stars only: no node is both a centre and a leaf, and no leaf has two centres.
        state = pairs.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("u").cast("decimal(38,0)")).alias("u"),
            F.sum(F.col("v").cast("decimal(38,0)")).alias("v"),
        ).first()
        if state == last:
            break
        last = state
    leaves = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(centres)
