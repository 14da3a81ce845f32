"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import held


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest one around it."""
    both = edges.union(edges.select("lo", "hi"))
    least = both.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return (edges.join(least, edges["lo"] == least["u"])
            .select("hi", F.col("m").alias("lo")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest one."""
    least = edges.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
    inner = (edges.join(least, edges["hi"] == least["u"]).where("lo <> m")
             .select(F.col("lo").alias("hi"), F.col("m").alias("lo")))
    return inner.union(least.select(F.col("u").alias("hi"), F.col("m").alias("lo"))).distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller node at most, and none from both sides."""
    ends = edges.select(F.col("hi").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("lo", F.lit(0), F.lit(1)))
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where("up > 1 OR up = 1 AND down = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node that has an edge ``(a, b)``.

    ``component`` is the smallest node reachable.  Self-loops and edges with a null
    end are left out; repeated edges count once.  Each round is written to the
    shared folder; the driver sees one yes or no per round.  A node of any degree is
    only ever aggregated before its shuffle or joined on, never gathered.
    """
    edges = (edges.where("a <> b")
             .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    edges = held(edges, "edges")
    while not _is_stars(edges):
        edges = held(_small_star(_large_star(edges)), "stars")
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        edges.select("lo", "lo").distinct())
