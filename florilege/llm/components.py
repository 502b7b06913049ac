"""Connected components of an edge table by alternating large and small stars.

Only labels move: each round joins nothing, it groups edges by a node and
points neighbours to the smallest one seen, so rounds are few and no component
is ever gathered in one place.  A node's group is its neighbours: minima are
taken on both sides of the shuffle, and come back by a join of two plain
shuffles, which adaptive execution splits where a star is large.  A round's
shuffle files go when its edges are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florilege.llm.shared import forget_shuffles, materialize, redealt


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """node, component (its smallest node) of each node that has an edge.  Nulls and loops are left out."""
    edges = materialize(edges.select(F.col(u).alias("u"), F.col(v).alias("v")).filter("u <> v").distinct())
    while True:
        both = _both(edges)
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(redealt(least), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(redealt(least), "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        after = materialize(small)
        ends = after.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(after.select("v", F.lit(0), F.lit(1)))
        # done when each node points to one other, and none that is pointed to points on
        open_ = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into")).filter("out > 1 OR (out = 1 AND into = 1)")
        edges, done = after, open_.isEmpty()
        del both, least, large, down, small, after, ends, open_
        forget_shuffles(edges.sparkSession)
        if done:
            break
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
