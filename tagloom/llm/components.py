"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum (combined before the shuffle) and a join with
the edges, so a node of many edges is no hot group.  The steps run on tables
checkpointed in the shared folder and end when the edges no longer change,
after about log2 of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v), u > v.  Large: the larger neighbours of each node move to
    its smallest one.  Small: a node and its smaller neighbours do."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("c", "m").alias("m"))
    if large:
        moved = both.where("v > u").join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = (edges.join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select(F.col("c").alias("u"), F.col("m").alias("v"))))
    return moved.where("u > v").distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(pairs: DataFrame) -> DataFrame:
    """pairs (a, b) of longs -> (node, root): every node that is not its
    component's smallest, with the smallest."""
    edges = pairs.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialize(edges, "edges")
    before = _state(edges)
    while True:
        edges = materialize(_star(_star(edges, True), False), "edges")
        now = _state(edges)
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
