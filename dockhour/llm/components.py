"""Connected components of an edge table by alternating large-star and small-star steps."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def shared_labels(edges: DataFrame, rounds: int = 2) -> DataFrame:
    """Edges (a, b) to rows (node, root) after a fixed number of steps of taking the least label.

    Nodes with the same ``root`` are connected; connected nodes need not have the same root.  Where
    components only serve to skip work, this is what it takes and costs a join for each round.
    """
    both = written(edges.select("a", "b").unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "both-ways")
    label = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root"))
    for _ in range(rounds - 1):
        near = both.join(label.withColumnRenamed("node", "b"), "b")
        label = near.groupBy(F.col("a").alias("node")).agg(
            F.least(F.min("root"), F.col("a")).alias("root"))
    return written(label, "labels")


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of longs to rows (node, root): each node's smallest reachable node.

    Only nodes that have an edge to another node and are not the root themselves get a row.  Every
    step is a grouped minimum with map-side combination and a join; a hot node's neighbours are
    never gathered.  The number of steps grows with the logarithm of the longest path.
    """
    e = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .filter("u <> v").distinct(), "edges")
    step = 0
    while not _stars(e):
        step += 1
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = written(both.join(low, "u").filter("v > u").select(
            F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct(), f"large{step}")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        e = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(),
                    f"small{step}")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _stars(e: DataFrame) -> bool:
    """Whether each node has one edge down and none up, or none down: no step changes that."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        e.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    more = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return not more.agg(F.max((F.col("down") > 1) | (F.col("down") > 0) & (F.col("up") > 0))).first()[0]
