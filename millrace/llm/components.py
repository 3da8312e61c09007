"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` edges to ``(node, component)``; the component is its smallest node.

    Alternates the large-star and small-star steps, which hang neighbours on the smallest
    node of their neighbourhood, until the edge set is a forest of stars. A step aggregates
    minima with partial sums and joins them back, so a node with many neighbours is split
    by the engine's skew join. Every round is written down, so lineage stays short.
    Nodes without an edge to another node do not appear.
    """
    edges = written(edges.where("a <> b").distinct(), "edges")
    state = None
    while True:
        edges = _large_star(edges)
        edges = written(_small_star(edges), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.union(edges.select(F.col("b"), F.col("b")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """For each node, its larger neighbours go to the smallest of it and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return (both.where("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """For each node, it and its smaller neighbours go to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
