"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reviewloom.session import materialize


def _doubled(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _least(edges: DataFrame) -> DataFrame:
    """(a, m): the smallest neighbour of each node, dealt out anew: a join with a table that comes from a shuffle of its
    own is one whose hot nodes adaptive execution splits."""
    return edges.groupBy("a").agg(F.min("b").alias("m")).repartition("a")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour (or the node)."""
    both = _doubled(edges)
    least = _least(both).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Of edges from a larger to a smaller node: every smaller neighbour of a node, and the node, move to the
    smallest of them."""
    least = _least(edges)
    moved = edges.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _only_stars(edges: DataFrame) -> bool:
    """Whether every node either is a root or has one edge, to a root."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("out")))
    roles = ends.groupBy("node").agg(F.sum("out").alias("outs"), F.min("out").alias("least"))
    return roles.filter("outs > 1 OR outs = 1 AND least = 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (a, b): the smallest id that links reach.

    Large-star and small-star rounds (Kiveris et al., 2014): every round is two aggregations and two
    joins, the minimum of a hub is combined before the shuffle, and no neighbourhood is collected. The
    rounds end when the edges are stars. Each round is written to the shared folder, so that a lost
    executor costs that round only. Self loops and repeated edges change nothing; null ends are dropped.
    """
    held = materialize(
        edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _only_stars(held):
        held = materialize(_small_star(_large_star(held)), "edges")
    roots = held.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
