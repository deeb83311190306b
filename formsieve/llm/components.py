"""Connected components of a graph given as edges, by alternating star contractions over written tables."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b): root is the smallest node that links reach; orderable ids of any type.

    Large-star hangs every larger neighbour of a node on the node's smallest neighbour, small-star does so with the smaller
    ones; the rounds end when every edge points at a root, after about log(nodes) rounds. A node's neighbours are never
    gathered: minima are partial aggregations and hot nodes are skewed joins, which Spark splits. Loops and null ends are
    ignored, repeated edges count once. No edges give an empty table.
    """
    known = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        both = known.unionByName(known.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = materialize(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        known = materialize(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        roots = known.select(F.col("v").alias("u")).distinct()
        if known.join(roots, "u", "left_semi").limit(1).count() == 0:
            break
    return known.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        known.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
