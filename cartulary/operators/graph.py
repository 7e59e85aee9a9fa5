"""Edges between entities: borders and hierarchies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartulary.session import enable_checkpoints


def edges(df: DataFrame, node: str, neighbours: str) -> DataFrame:
    """Distinct ``src, dst`` from a neighbour list."""
    return df.select(F.col(node).alias("src"), F.explode(neighbours).alias("dst")).filter(
        F.col("dst").isNotNull()
    ).distinct()


def missing_reverse(edge: DataFrame) -> DataFrame:
    """Edges whose opposite direction is not listed. The key is the pair, so hubs spread."""
    swapped = edge.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return edge.join(swapped, ["src", "dst"], "left_anti")


def ancestor_closure(edge: DataFrame, child: str, parent: str, max_depth: int | None = None) -> DataFrame:
    """All ``node, ancestor, depth`` with the least depth; a node is not its own ancestor.

    Each round doubles the reach: the pairs at exactly the present reach are continued by
    all pairs found so far, and what is known already is dropped, which ends cycles. A
    hierarchy of depth d takes about log2(d) rounds. A round is written to the checkpoint
    folder, so the plan stays short and a lost executor costs no earlier round. An
    ancestor that many nodes share is split at run time. A parent without a row of its own ends its
    branch. It ends by itself; a caller that wants a guard may set ``max_depth``, and a
    deeper hierarchy then fails rather than return part of the closure.
    """
    enable_checkpoints(edge.sparkSession)
    newest = (
        edge.select(F.col(child).alias("node"), F.col(parent).alias("ancestor"), F.lit(1).alias("depth"))
        .filter(F.col("node").isNotNull() & F.col("ancestor").isNotNull() & (F.col("node") != F.col("ancestor")))
        .distinct()
        .checkpoint()
    )
    found, reach = newest, 1
    while True:
        farthest = newest.filter(F.col("depth") == reach).select(
            F.col("node").alias("_start"), F.col("ancestor").alias("node")
        )
        climbed = (
            farthest.join(found, "node")
            .filter(F.col("_start") != F.col("ancestor"))
            .groupBy(F.col("_start").alias("node"), "ancestor")
            .agg((F.min("depth") + reach).alias("depth"))
        )
        newest = climbed.join(found, ["node", "ancestor"], "left_anti").checkpoint()
        deepest = newest.agg(F.max("depth")).first()[0]
        if deepest is None:
            return found
        if max_depth is not None and deepest > max_depth:
            raise ValueError(f"hierarchy is deeper than {max_depth} levels")
        found, reach = found.unionByName(newest), reach * 2
