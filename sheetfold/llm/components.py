"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetfold.llm.common import store


def connected_components(edges: DataFrame) -> DataFrame:
    """``(a long, b long)`` edges → ``(node, root)``: every node with the smallest node it reaches.

    Alternating large-star and small-star rounds: each node's neighbours are linked to its
    smallest neighbour, larger ones first, then smaller ones, until all trees are stars. Edges
    per round do not grow, a node's neighbours are only ever reduced to their minimum (partial
    aggregates) and joined with it, and each round is written to the shared folder.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = store(pairs, "cc")
    while True:
        many = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1)
        deep = pairs.join(pairs.select(F.col("a").alias("b")).distinct(), "b", "left_semi").limit(1)
        if many.isEmpty() and deep.isEmpty():
            break
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        pairs = store(small, "cc")
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
