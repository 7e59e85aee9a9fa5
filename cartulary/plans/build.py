"""Build plan: scan → set bad documents aside → normalise → conform → publish."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartulary.operators.conform import conform, violations
from cartulary.operators.normalize import normalise, rules_for
from cartulary.schemas import block_schema, block_type_schema, country_schema
from cartulary.session import enable_checkpoints
from cartulary.sinks.publish import FORMATS, ZSTD_LEVEL, parse_formats, publish, published_counts, row_counts, write_parquet
from cartulary.sources.documents import (
    Parser,
    accounts,
    drop_empty,
    good_documents,
    list_documents,
    quarantined,
    scan_documents,
    yaml_parser,
)

SCHEMAS = {"countries": country_schema, "intblocks": block_schema, "blocktypes": block_type_schema}


@dataclass
class Dataset:
    """Stages of one data set, all lazy."""

    name: str
    documents: DataFrame
    typed: DataFrame
    quarantine: DataFrame
    violations: DataFrame


def build_dataset(parsed: DataFrame, name: str, schema: T.StructType | None = None, mode: str = "permissive") -> Dataset:
    """Stages from parsed documents (``path, doc, error``) for a named rule set."""
    schema = schema or SCHEMAS[name]()
    rules = rules_for(name, compat=mode == "compat")
    good = drop_empty(good_documents(parsed))
    return Dataset(
        name=name,
        documents=normalise(good, "doc", rules),
        typed=conform(good, "doc", schema, mode, rules),
        quarantine=quarantined(parsed),
        violations=violations(good.withColumnRenamed("path", "document"), "doc", schema, rules, keep=["document"]),
    )


ACCOUNTS = "table_name string, n_documents bigint, n_good bigint, n_empty bigint, n_quarantined bigint"


def build_parsed(
    spark: SparkSession,
    parsed: Mapping[str, DataFrame],
    output: str,
    formats: str | Sequence[str] = FORMATS,
    mode: str = "permissive",
    database: str | None = None,
    level: int = ZSTD_LEVEL,
) -> DataFrame:
    """Publish parsed documents (``path, doc, error``) of named rule sets, and account for them.

    Each data set is parsed once, into the checkpoint folder; its documents are counted on the
    way. Beside each table lie ``<name>.quarantine`` (``path, error``) and ``<name>.violations``
    (``document`` and the place of each value that was turned into null).
    Returns ``table_name, n_documents, n_good, n_empty, n_quarantined, n_published,
    n_violations``: a document is good, empty or quarantined, and the good ones are published.
    What was published is counted in the files.
    """
    asked = parse_formats(formats)
    enable_checkpoints(spark)
    root, found = output.rstrip("/"), []
    for name, frame in parsed.items():
        counted = Observation(f"{name}_documents")
        once = frame.observe(counted, *accounts()).checkpoint()
        stages = build_dataset(once, name, mode=mode)
        publish({name: stages.typed}, root, asked, database, {name: (stages.documents, "doc")}, level)
        write_parquet(stages.quarantine.select("path", "error"), f"{root}/{name}.quarantine")
        write_parquet(stages.violations, f"{root}/{name}.violations")
        found.append((name, *(counted.get[n] for n in ("n_documents", "n_good", "n_empty", "n_quarantined"))))
    cheapest = next(f for f in ("parquet", "table", "jsonl") if f in asked)
    published = published_counts(spark, list(parsed), root, [cheapest]).select("table_name", F.col("n_rows").alias("n_published"))
    broken = row_counts({name: spark.read.parquet(f"{root}/{name}.violations") for name in parsed}).withColumnRenamed("n_rows", "n_violations")
    return spark.createDataFrame(found, ACCOUNTS).join(published, "table_name").join(broken, "table_name")


def build(
    spark: SparkSession,
    countries: str,
    blocks: str,
    block_types: str,
    output: str,
    formats: str | Sequence[str] = FORMATS,
    glob: str = "*.yaml",
    parser: Parser | None = yaml_parser,
    mode: str = "permissive",
    database: str | None = None,
    level: int = ZSTD_LEVEL,
) -> DataFrame:
    """Build and publish the three tables; returns what ``build_parsed`` returns.

    Every file counts as one document, an element of the list of block types as well; files that
    hold no list, could not be read or parsed are in the quarantine of their table.
    ``level`` is the zstd level of Parquet files; ``ARCHIVE_ZSTD_LEVEL`` suits a last release.
    """
    parsed = {
        "countries": scan_documents(spark, countries, glob, parser),
        "intblocks": scan_documents(spark, blocks, glob, parser),
        "blocktypes": list_documents(scan_documents(spark, block_types, "*", parser)),
    }
    return build_parsed(spark, parsed, output, formats, mode, database, level)
