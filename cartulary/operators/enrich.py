"""Code crosswalk, enrichment and referential integrity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Restores leading zeros.
NUMERIC_WIDTH = 3


def canonical_code(code: Column) -> Column:
    """Trimmed upper-case code; numbers get their leading zeros back."""
    text = F.upper(F.trim(code))
    return F.when(text.rlike("^[0-9]{1,2}$"), F.lpad(text, NUMERIC_WIDTH, "0")).otherwise(text)


def canonical_language(code: Column) -> Column:
    return F.lower(F.trim(code))


def crosswalk(dim: DataFrame, key: str, schemes: Mapping[str, str]) -> DataFrame:
    """``code_key, scheme, <key>``: one row per distinct code and scheme of the dimension."""
    pairs = F.array(
        *[
            F.struct(F.lit(scheme).alias("scheme"), canonical_code(F.col(column).cast("string")).alias("code_key"))
            for scheme, column in schemes.items()
        ]
    )
    rows = dim.select(F.col(key), F.inline(pairs)).filter(F.col("code_key").isNotNull() & (F.col("code_key") != ""))
    return rows.select("code_key", "scheme", key)


def resolve_codes(facts: DataFrame, code: str, walk: DataFrame, key: str) -> DataFrame:
    """Attach the dimension key to a free-form code: adds ``key`` and ``scheme``.

    A code that several schemes share with one meaning is taken once. A code that could
    mean several rows stays unresolved.
    """
    meanings = walk.groupBy("code_key").agg(
        F.min(key).alias("_low"), F.max(key).alias("_high"), F.min("scheme").alias("scheme")
    )
    single = meanings.filter(F.col("_low") == F.col("_high")).select("code_key", "scheme", F.col("_low").alias(key))
    tagged = facts.withColumn("code_key", canonical_code(F.col(code).cast("string")))
    return tagged.join(single, "code_key", "left").drop("code_key")


def enrich(facts: DataFrame, dim: DataFrame, on: Sequence[str], attributes: Sequence[str], flag: str = "matched") -> DataFrame:
    """Left join the attributes of a dimension with unique keys; unmatched facts are kept.

    Spark broadcasts the dimension where its size allows, known from statistics or measured; else
    the join shuffles and heavy keys are split at run time.
    """
    side = dim.select(*on, *attributes).withColumn(flag, F.lit(True))
    joined = facts.join(side, list(on), "left")
    return joined.withColumn(flag, F.coalesce(flag, F.lit(False)))


def dangling(facts: DataFrame, reference: str, dim: DataFrame, key: str) -> DataFrame:
    """References without a row in the dimension: ``reference, n``.

    Counted per reference before the join, so a hot reference is one row by then.
    """
    counted = facts.filter(F.col(reference).isNotNull()).groupBy(F.col(reference).alias("reference")).agg(
        F.count("*").alias("n")
    )
    return counted.join(dim.select(F.col(key).alias("reference")), "reference", "left_anti")
