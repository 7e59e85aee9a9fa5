"""Quality rules, line dedup, near-duplicate dedup, decontamination and packing, one after another."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.llm import decontamination, line_dedup, minhash_dedup, packing, quality
from cartulary.llm.shared import NO_ID, keyed, read, salt_of, store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _with_key(docs: DataFrame) -> DataFrame:
    """``doc, salt, text`` as operators know a document, and its ``row`` of all columns."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), salt_of(text).alias("salt"), text.alias("text"),
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
    )


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.judge(docs).where("kept").select("row.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Frequent lines go from all documents but one; all documents stay."""
    rows = _with_key(docs)
    cut = line_dedup.cut(keyed(docs), rows, line_dedup.MIN_CHARS, line_dedup.MIN_DOCS, line_dedup.FILTER_BITS)
    texts = cut.select("row", line_dedup.kept().alias("kept"))
    new = {"text": F.when(F.col("row.text").isNotNull(), F.col("kept")), "n_chars": F.length("kept").cast(docs.schema["n_chars"].dataType)}
    return texts.select(*[new.get(c, F.col(f"row.{c}")).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document stays, that of the least id."""
    kept = minhash_dedup.near_duplicates(keyed(docs)).where("row = class_row").select("doc", "salt").distinct()
    # rows equal in id and text are one before they are moved
    rows = _with_key(docs).groupBy("doc", "salt").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return rows.join(kept, ["doc", "salt"]).select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", drop_lines),
    ("minhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("packing", pack),
]
# Tokens, near-duplicate classes and sequences are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
