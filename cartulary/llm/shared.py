"""What the operators share on the Spark side."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.session import enable_checkpoints, scratch_path

# Stands for a missing id: such a document comes after all others and before none.
NO_ID = (1 << 63) - 1
# Few enough for the exchanges of op1 and op3, which send it with every anchor; n rows of one id collide at n*n/2^97.
SALT_BYTES = 12
# Blanks that separate words, as a character class of a regular expression.
BLANK = r"[\x20\x09-\x0D]"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def store(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again, which also cuts the lineage."""
    spark = df.sparkSession
    enable_checkpoints(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written within leaves no shuffle files behind, which else lie on disk until the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def salt_of(text: Column) -> Column:
    """What tells rows of one id apart: ``SALT_BYTES`` of SHA-256, as rows that share an id (such as null) may be millions."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 2 * SALT_BYTES))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, salt, text``: the id, what tells rows of one id apart, and the text, null as empty.

    Rows without an id get ``NO_ID``. Only these two columns are read; others may have any name.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
        salt_of(text).alias("salt"),
        text.alias("text"),
    )


def doc_id() -> Column:
    """The id as it was."""
    return F.nullif(F.col("doc"), F.lit(NO_ID)).alias("doc_id")


def text_size(docs: DataFrame) -> int:
    """Bytes of all texts."""
    return docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
