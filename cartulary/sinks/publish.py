"""Publish tables as JSON lines, Parquet and catalog tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from cartulary.session import enable_checkpoints

FORMATS = ("jsonl", "parquet", "table")
ZSTD_LEVEL = 3
ARCHIVE_ZSTD_LEVEL = 22


def write_json_lines(df: DataFrame, path: str, doc: str | None = None, compression: str = "gzip") -> None:
    """One object per line, UTF-8 as it is.

    With ``doc`` the raw VARIANT documents are written: absent fields stay absent and
    undeclared ones are kept. Without, the typed columns are, null fields left out.
    """
    if doc is not None:
        lines = df.select(F.to_json(F.col(doc)).alias("value"))
        lines.write.mode("overwrite").option("compression", compression).text(path)
    else:
        df.write.mode("overwrite").option("compression", compression).json(path)


def write_parquet(df: DataFrame, path: str, level: int = ZSTD_LEVEL, partition_by: Sequence[str] = ()) -> None:
    """Parquet with native nesting, zstd compressed.

    A ``level`` of ``ARCHIVE_ZSTD_LEVEL`` suits small tables that are written once and downloaded often;
    the default writes large tables many times faster.
    """
    writer = df.write.mode("overwrite").option("compression", "zstd")
    writer = writer.option("parquet.compression.codec.zstd.level", str(level))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_table(df: DataFrame, name: str, path: str | None = None, buckets: int | None = None, by: Sequence[str] = ()) -> None:
    """Drop and recreate a catalog table, at ``path`` if given.

    With ``buckets`` it is laid out by the hash of the columns ``by`` and sorted by them: tables of one
    layout are joined and grouped on these columns without an exchange. Rows go to their
    bucket first, so that each has one file.
    """
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    if buckets is not None:
        df = df.repartition(buckets, *by)
    writer = df.write.mode("overwrite").format("parquet")
    if buckets is not None:
        writer = writer.bucketBy(buckets, *by).sortBy(*by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, n_rows`` for each table."""
    counted = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        counted = one if counted is None else counted.unionByName(one)
    if counted is None:
        raise ValueError("no tables")
    return counted


def parse_formats(formats: str | Sequence[str]) -> list[str]:
    """Comma-separated or listed formats, checked."""
    names = formats.split(",") if isinstance(formats, str) else formats
    asked = [name.strip().lower() for name in names]
    unknown = sorted(set(asked) - set(FORMATS))
    if unknown:
        raise ValueError(f"unknown formats: {', '.join(unknown)}; known: {', '.join(FORMATS)}")
    return asked


def publish(
    tables: Mapping[str, DataFrame],
    output: str,
    formats: str | Sequence[str] = FORMATS,
    database: str | None = None,
    documents: Mapping[str, tuple[DataFrame, str]] | None = None,
    level: int = ZSTD_LEVEL,
) -> None:
    """Write every table in every format under ``output``, what is there overwritten.

    Each table is computed once and kept (memory, then disk, recomputed from its lineage
    if an executor is lost) while its formats are written. ``documents`` names the raw
    frame and VARIANT column for JSON lines where these differ from the typed table.
    """
    asked = parse_formats(formats)
    root = output.rstrip("/")
    for name, df in tables.items():
        typed = [f for f in asked if f != "jsonl" or not (documents and name in documents)]
        kept = df.persist(StorageLevel.MEMORY_AND_DISK) if len(typed) > 1 else df
        if "jsonl" in asked:
            raw, doc = (documents or {}).get(name, (kept, None))
            write_json_lines(raw, f"{root}/{name}.jsonl", doc)
        if "parquet" in asked:
            write_parquet(kept, f"{root}/{name}.parquet", level)
        if "table" in asked:
            write_table(kept, f"{database}.{name}" if database else name, f"{root}/{name}.table")
        if len(typed) > 1:
            kept.unpersist()


def published_counts(spark: SparkSession, names: Sequence[str], output: str, formats: Sequence[str]) -> DataFrame:
    """``table_name, format, n_rows`` of what ``publish`` wrote, read back."""
    root = output.rstrip("/")
    readers = {
        "jsonl": lambda name: spark.read.text(f"{root}/{name}.jsonl"),
        "parquet": lambda name: spark.read.parquet(f"{root}/{name}.parquet"),
        "table": lambda name: spark.read.parquet(f"{root}/{name}.table"),
    }
    counted = None
    for fmt in formats:
        one = row_counts({name: readers[fmt](name) for name in names}).withColumn("format", F.lit(fmt))
        counted = one if counted is None else counted.unionByName(one)
    return counted


SHARE = "share"


def _shared(df: DataFrame, key: str, shares: int) -> DataFrame:
    return df.withColumn(SHARE, F.pmod(F.xxhash64(key), F.lit(shares)).cast("int"))


def publish_members(pairs: DataFrame, path: str, block: str = "block", shares: int = 64) -> None:
    """A table of members in ``shares`` partitions by a hash of the block, which ``merge_published`` rewrites one by one."""
    _shared(pairs, block, shares).repartition(shares, SHARE).write.mode("overwrite").partitionBy(SHARE).parquet(path)


def merge_published(spark: SparkSession, path: str, additions: DataFrame, block: str = "block", member: str = "member", shares: int = 64) -> int:
    """Add the pairs that a published table of members lacks; returns how many.

    Only partitions that get new pairs are read as a whole and replaced. What they will hold is written to
    the checkpoint folder before anything is replaced, and pairs already there are no news: running
    it again, also after a failure, adds what is missing and changes no file where nothing is.
    ``shares`` is that of ``publish_members``.
    """
    enable_checkpoints(spark)
    schema = additions.select(block, member).schema.add(SHARE, T.IntegerType())
    held = spark.read.schema(schema).parquet(path)
    asked = _shared(additions.select(block, member).distinct(), block, shares)
    news = asked.join(held, [block, member, SHARE], "left_anti").checkpoint()
    counted = news.groupBy(SHARE).count().collect()  # at most a row for each share
    if counted:
        touched = [r[SHARE] for r in counted]
        whole = held.filter(F.col(SHARE).isin(touched)).unionByName(news).checkpoint()
        writer = whole.repartition(len(touched), SHARE).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(SHARE).parquet(path)
    return sum(r["count"] for r in counted)
