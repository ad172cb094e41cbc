"""Connected components of edge tables, by alternating stars until nothing changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

ROUNDS = 50


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of the edges; a component is named by its smallest node.

    Large star: each node hands its larger neighbours to the smallest node around it. Small star: each node hands
    itself and its smaller neighbours to the smallest of them. Both keep components and flatten them to stars; all
    rows stay distributed, and only a checksum of the edges comes to the driver.
    """
    edges = written(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "edges")
    before = None
    for _ in range(ROUNDS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Written, so that Spark can split the rows of a node with very many neighbours when they are joined.
        least = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least")), "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()
        large = written(large, "large-star")  # every edge points from the larger to the smaller node
        pairs = large.join(large.groupBy("a").agg(F.min("b").alias("least")), "a")
        small = pairs.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(pairs.select("a", F.col("least").alias("b")))
        edges = written(small.where("a <> b").distinct(), "small-star")
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
