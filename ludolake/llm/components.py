"""Connected components of an undirected graph, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import at_most, discard, stage


def _flat(edges: DataFrame) -> bool:
    """Whether every node has one edge down, to a node that has none: then that is the smallest it reaches."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("root"))
    ends = ends.union(edges.select(F.col("v").alias("x"), F.lit(0).alias("down"), F.lit(1).alias("root")))
    ends = ends.groupBy("x").agg(F.sum("down").alias("down"), F.max("root").alias("root"))
    return at_most(ends.where("down + root > 1"), 0)


def connected(links: DataFrame) -> DataFrame:
    """``links`` (a long, b long) to (node, component): the smallest node it reaches.

    Only linked nodes are returned. Minimums are partial aggregates and joins back
    are plain ones, so a node with a third of all links is not gathered anywhere.
    Each round is written to the shared folder, which cuts the lineage; the number
    of rounds grows with the logarithm of the longest path.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stage(edges, "edges")
    while not _flat(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(small, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, edges = edges, stage(linked.union(small.select("u", F.col("m").alias("v"))).distinct(), "edges")
        discard(last)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
