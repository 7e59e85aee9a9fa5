"""Facet counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.functions.plan import compute_once


def facet_counts(df: DataFrame, facets: Sequence[str], subtotals: str = "none") -> DataFrame:
    """Counts by facet values. ``subtotals`` is ``none``, ``rollup`` or ``cube``.

    ``level`` is the grouping id: one bit per facet that is rolled up.
    """
    if subtotals == "none":
        return df.groupBy(*facets).agg(F.count("*").alias("n"))
    if subtotals not in ("rollup", "cube"):
        raise ValueError(f"unknown subtotals: {subtotals}")
    grouped = df.rollup(*facets) if subtotals == "rollup" else df.cube(*facets)
    return grouped.agg(F.grouping_id().alias("level"), F.count("*").alias("n"))


def array_facets(df: DataFrame, values: Column) -> DataFrame:
    """Value counts of an array column: ``value, n, n_documents``; a row is a document.

    Each row yields its values once as they are and once without repeats, so documents
    are counted without a distinct aggregate: one shuffle, combined on the map side.
    """
    both = F.array(
        F.struct(F.col("_values").alias("values"), F.lit(0).alias("distinct")),
        F.struct(F.array_distinct("_values").alias("values"), F.lit(1).alias("distinct")),
    )
    rows = compute_once(df, _values=values).select(F.inline(both))
    exploded = rows.select(F.explode("values").alias("value"), "distinct")
    return exploded.groupBy("value").agg(
        F.count_if(F.col("distinct") == 0).alias("n"), F.count_if(F.col("distinct") == 1).alias("n_documents")
    )


def count_differences(df: DataFrame, keep: Sequence[str], declared: Column, members: Column) -> DataFrame:
    """Rows whose declared count differs from the number of members."""
    return df.select(
        *keep,
        declared.cast("bigint").alias("declared"),
        F.coalesce(F.size(members), F.lit(0)).cast("bigint").alias("actual"),
    ).filter(F.col("declared") != F.col("actual"))


def daily_sketches(df: DataFrame, facet: str, day: Column, entity: str, precision: int = 14) -> DataFrame:
    """``facet, day, n, entities``: a count and a HyperLogLog sketch for each value and day.

    A sketch has a bound on its size whatever the day holds; days are stored and united later, so no
    event is read twice. Its relative error is about ``1.04 / sqrt(2 ** precision)``.
    """
    sketch = F.hll_sketch_agg(entity, precision)
    return df.groupBy(F.col(facet).alias("facet"), day.alias("day")).agg(F.count("*").alias("n"), sketch.alias("entities"))


def facets_between(sketches: DataFrame, first: Column, last: Column) -> DataFrame:
    """``facet, n, n_entities`` over the days from ``first`` to ``last``: counts are exact, different entities estimated."""
    days = sketches.filter((F.col("day") >= first) & (F.col("day") <= last))
    return days.groupBy("facet").agg(F.sum("n").alias("n"), F.hll_sketch_estimate(F.hll_union_agg("entities")).alias("n_entities"))
