"""Localised names and alias resolution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.functions.plan import compute_once
from cartulary.functions.text import squeeze


def localised_name(names: Column, languages: Sequence[str], canonical: Column, key: str = "id") -> Column:
    """Name in the first listed language that has one, else the canonical name.

    Where a language is repeated the first entry counts.
    """

    def pick(language: str) -> Column:
        return F.get(F.filter(names, lambda n: n[key] == language), F.lit(0))["name"]

    return F.coalesce(*[pick(language) for language in languages], canonical)


def alias_entries(kinds: dict[str, Column]) -> Column:
    """array<struct<kind, alias>> from text columns and arrays of text."""
    empty = F.array().cast("array<struct<kind:string,alias:string>>")

    def entries(kind: str, values: Column) -> Column:
        tagged = F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("alias")))
        return F.coalesce(tagged, empty)

    return F.concat(*[entries(kind, values) for kind, values in kinds.items()])


def alias_table(df: DataFrame, key: str, kinds: dict[str, Column]) -> DataFrame:
    """Distinct ``alias, id, kind`` with normalised aliases. ``kinds`` maps a kind to an
    array of text."""
    rows = df.select(F.col(key).alias("id"), F.inline(alias_entries(kinds))).withColumnRenamed("alias", "_spelling")
    named = compute_once(rows, alias=squeeze(F.col("_spelling")))
    return named.filter(F.col("alias") != "").select("alias", "id", "kind").distinct()


def alias_meanings(aliases: DataFrame) -> DataFrame:
    """One row per alias: ``alias, n_ids, id``; the id is NULL where the alias is ambiguous."""
    counted = (
        aliases.select("alias", "id")
        .distinct()
        .groupBy("alias")
        .agg(F.count("*").alias("n_ids"), F.min("id").alias("_id"))
    )
    return counted.select("alias", "n_ids", F.when(F.col("n_ids") == 1, F.col("_id")).alias("id"))


def resolve_mentions(mentions: DataFrame, mention: str, aliases: DataFrame) -> DataFrame:
    """``alias, n_mentions, n_ids, id, status`` for each distinct mention.

    Mentions are counted as they stand, then normalised, once per distinct spelling, and
    counted again. Meanings are folded too, so the join has one row per alias on either
    side and neither a frequent word nor an ambiguous alias multiplies rows.
    """
    spelled = mentions.groupBy(F.col(mention).alias("_spelling")).agg(F.count("*").alias("_n"))
    counted = (
        compute_once(spelled, alias=squeeze(F.col("_spelling")))
        .filter(F.col("alias") != "")
        .groupBy("alias")
        .agg(F.sum("_n").alias("n_mentions"))
    )
    status = F.when(F.col("n_ids") == 0, "unknown").when(F.col("n_ids") == 1, "resolved").otherwise("ambiguous")
    return (
        counted.join(alias_meanings(aliases), "alias", "left")
        .withColumn("n_ids", F.coalesce("n_ids", F.lit(0)))
        .withColumn("status", status)
    )
