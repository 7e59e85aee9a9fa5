"""Documents that keep arriving: the batch rules on a file stream.

Parsing, normalising and conforming are row-local, so a stream runs the same functions as
a batch. There is no state and hence no watermark.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cartulary.functions.variants import Rule
from cartulary.operators.conform import conform
from cartulary.sources.documents import drop_empty, good_documents, parse_documents, quarantined


def stream_json_lines(spark: SparkSession, directory: str, files_per_trigger: int = 1000) -> DataFrame:
    """One document per line from files as they arrive: ``path, doc, error``."""
    lines = (
        spark.readStream.option("maxFilesPerTrigger", str(files_per_trigger))
        .text(directory)
        .select(F.col("_metadata.file_path").alias("path"), "value")
    )
    return parse_documents(lines, "value")


def ingest(
    parsed: DataFrame,
    schema: T.StructType,
    output: str,
    checkpoint: str,
    rules: Mapping[str, Rule] | None = None,
) -> StreamingQuery:
    """Append conformed documents to ``output/good`` and the rest to ``output/quarantine``.

    Processes what is there and stops. The batch number is part of the folder, so a batch
    that is run again after a failure replaces its own output.
    """
    root = output.rstrip("/")

    def write(batch: DataFrame, number: int) -> None:
        kept = batch.persist()
        typed = conform(drop_empty(good_documents(kept)), "doc", schema, rules=rules, keep=["path"])
        typed.write.mode("overwrite").parquet(f"{root}/good/batch={number}")
        bad = quarantined(kept).select("path", "value", "error")
        bad.write.mode("overwrite").parquet(f"{root}/quarantine/batch={number}")
        kept.unpersist()

    return (
        parsed.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
