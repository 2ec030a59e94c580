"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockwise.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of
    ``edges`` (columns a, b; any order, repeats and loops allowed).

    Each round points every node's larger neighbours, then its smaller ones, at
    its smallest neighbour, until each node points at its component's smallest.
    Minima are pre-aggregated, so a node with very many neighbours costs one row
    per task, and the join back to its edges can be split by AQE. Rounds grow
    with the logarithm of the longest path; every round is a written table.
    """
    step = 0
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = stored(pairs, "edges")
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.where("m < u").select("u", F.col("m").alias("v"))).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v")))
                 .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
        step += 1
        after = stored(small, f"stars-{step}")
        n, roots, lines = after.agg(
            F.count(F.lit(1)), F.count_distinct("v"), F.count_distinct("u")).first()
        # a star forest: one line per non-root node, and no root is itself below another
        if n == lines and not after.select("v").distinct().join(after.select(F.col("u").alias("v")), "v", "left_semi").take(1):
            nodes = after.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return nodes.unionByName(after.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        pairs = after
