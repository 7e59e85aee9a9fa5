"""Legacy exports: JSON arrays of ``{id, createdTime, fields{…}}`` records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartulary.functions.variants import is_object
from cartulary.operators.conform import conform
from cartulary.schemas import legacy_schema
from cartulary.sources.documents import list_documents, scan_documents


def flatten_records(df: DataFrame) -> DataFrame:
    return df.select("id", "createdTime", "fields.*")


def legacy_documents(files: DataFrame, schema: T.StructType | None = None) -> tuple[DataFrame, DataFrame]:
    """Records of scanned export files (``path, doc, error``), and what is no record: ``path, position, error``.

    Every element of every file is in one of the two: files that could not be parsed or hold no list, and
    elements that are no objects, are set aside; an empty file or list gives neither.
    """
    rows = list_documents(files)
    odd = F.when(F.col("position").isNotNull() & ~is_object(F.col("doc")), F.lit("not a record"))
    rows = rows.withColumn("error", F.coalesce("error", odd))
    good = rows.filter(F.col("error").isNull() & F.col("position").isNotNull())
    typed = conform(good, "doc", schema or legacy_schema())
    return flatten_records(typed), rows.filter(F.col("error").isNotNull()).select("path", "position", "error")


def read_legacy(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The records of an export or a folder of them, their fields lifted to the top.

    A file is read by one task; exports are small and come in many files. ``legacy_documents``
    also gives what is set aside.
    """
    return legacy_documents(scan_documents(spark, path, "*"), schema)[0]
