"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b); root is the component's smallest node.

    Alternating large-star and small-star rounds: each node's larger neighbours,
    then its smaller ones, are tied to the smallest node in reach, until the edges
    are stars.  The smallest neighbour comes from an aggregation that combines on
    the map side and is written, so a hub's edges are never gathered in one task;
    the number of rounds grows with the logarithm of the component size.  Each
    round's edges are a written table.
    """
    edges = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .filter("a <> b").distinct(), "edges")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.min("b").alias("m"))
                            .select("a", F.least("a", "m").alias("m")), "large_star")
        large = materialize(both.filter("b > a").join(least, "a")
                            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large_edges")
        least = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "small_star")
        edges = materialize(large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
                            .unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _stars(edges: DataFrame) -> bool:
    """True if every larger node has one edge and no node is the larger and the smaller one of edges."""
    roles = edges.select(F.col("a").alias("node"), F.lit(1).alias("leaf"), F.lit(0).alias("hub")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("leaf"), F.lit(1).alias("hub")))
    return roles.groupBy("node").agg(F.sum("leaf").alias("leaf"), F.max("hub").alias("hub")).filter(
        "leaf > 1 OR (leaf = 1 AND hub = 1)").isEmpty()
