"""Connected components by alternating star contractions, each round a written table that replaces the one before."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidebars.session import Rounds


def _digest(edges: DataFrame):
    return edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(high, low))")).first()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest neighbour."""
    both = edges.select(F.col("high").alias("u"), F.col("low").alias("v")).unionByName(
        edges.select(F.col("low").alias("u"), F.col("high").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.filter("v > u").join(least, "u").select(F.col("v").alias("high"), F.col("m").alias("low"))
    return moved.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of these."""
    least = edges.groupBy("high").agg(F.min("low").alias("m"))
    moved = edges.join(least, "high").filter("low <> m").select(F.col("low").alias("high"), F.col("m").alias("low"))
    return moved.unionByName(least.select("high", F.col("m").alias("low"))).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node in ``edges(high, low)``, integers with high > low; root is the smallest of its component.

    Ends when a round leaves the edges as they are: then each component is one star. A node with very many edges is split
    by the skew join, minima are taken before rows are shuffled.
    """
    written = Rounds(edges.sparkSession, "edges")
    edges = written.write(edges.distinct())
    before = _digest(edges)
    while before[0]:
        edges = written.write(_small_star(_large_star(edges)))
        now = _digest(edges)
        if tuple(now) == tuple(before):
            break
        before = now
    stars = edges.select(F.col("high").alias("node"), F.col("low").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
