"""Connected components of a graph given by its edges, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartulary.llm.shared import store


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(38)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (its least node) of all nodes in ``edges`` (``a, b``, longs).

    Every round hangs the larger neighbours of each node under its least neighbour, then all
    smaller ones; both use the least neighbour of a node only, an aggregate that combines
    before it shuffles, so a node with very many neighbours is nothing special. Ends when a
    round changes nothing, after a number of rounds logarithmic in the longest path.
    """
    edges = store(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _mark(edges)
    while True:
        sides = _both_ways(edges)
        least = sides.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = sides.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b")))
        edges = store(small.where("a <> b").distinct(), "edges")
        after = _mark(edges)
        if after == before:
            break
        before = after
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
