"""Duplicate identities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicates(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Rows whose key occurs more than once, with ``n_copies`` and ``kept``.

    ``order`` decides which copy is kept and must tell the copies of a key apart. Counts
    and the kept copy come from one aggregate with map-side combine, not from a window
    that would pull all copies of a hot key into one task; on the way back to the rows heavy
    keys are split at run time.
    """
    picked = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("n_copies"), F.min(F.struct(*order)).alias("_first"))
        .filter(F.col("n_copies") > 1)
    )
    rows = df.join(picked, key)
    return rows.withColumn("kept", F.struct(*order) == F.col("_first")).drop("_first")


def keep_one(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order``."""
    rest = [c for c in df.columns if c != key]
    picked = df.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(key, "_row.*").select(*df.columns)
