"""Shaping of plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns that later filters refer to.

    A filter moves below the projection that defines its columns, where their expressions
    are computed a second time for the same row. Columns that come out of a generator, here
    one that yields exactly one row, stay computed once.
    """
    made = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(made)))
