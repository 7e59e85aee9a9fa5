"""Documents: one per file, one per row, or a list of them in one file.

A parsed frame has the columns ``path, doc, error``: ``doc`` is VARIANT and ``error`` is
set when the text could not be parsed, so that one bad document never stops a load.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.functions.plan import compute_once
from cartulary.functions.variants import as_elements, as_text, is_array, is_falsy, is_null, kind
from cartulary.sources.files import problem_of, read_files, text_of

Parser = Callable[[str], object]
MALFORMED = "malformed document"


def parse_documents(df: DataFrame, text: str, doc: str = "doc", error: str = "error") -> DataFrame:
    """Parse a JSON text column into a VARIANT column, malformed text set aside."""
    parsed = compute_once(df, **{doc: F.try_parse_json(F.col(text))})
    broken = F.col(text).isNotNull() & F.col(doc).isNull()
    return parsed.withColumn(error, F.when(broken, F.lit(MALFORMED)))


class MalformedDocument(ValueError):
    """Raised by a parser that words the problem itself."""


def yaml_parser(text: str) -> object:
    """YAML 1.1 with safe tags. Needs PyYAML on the executors."""
    import yaml

    try:
        return yaml.load(text, Loader=getattr(yaml, "CSafeLoader", yaml.SafeLoader))
    except yaml.YAMLError as problem:
        raise MalformedDocument(f"YAML error: {problem}") from problem


UNHELD = "holds a value without a JSON form: not a finite number, or two keys of one name"


def _with_parser(files: DataFrame, parser: Parser) -> DataFrame:
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, text, error in zip(batch["path"], batch["text"], batch["error"]):
                if text is None:
                    rows.append((path, None, error))
                    continue
                try:
                    value = parser(text)
                    rows.append((path, json.dumps(value, ensure_ascii=False, default=str), None))
                except Exception as problem:  # any parser failure belongs to this one file
                    rows.append((path, None, str(problem) or type(problem).__name__))
            yield pd.DataFrame(rows, columns=["path", "text", "error"])

    parsed = compute_once(files.mapInPandas(parse, "path string, text string, error string"), doc=F.try_parse_json("text"))
    unheld = F.when(F.col("text").isNotNull() & F.col("doc").isNull(), F.lit(UNHELD))
    return parsed.select("path", "doc", F.coalesce("error", unheld).alias("error"))


def scan_documents(spark: SparkSession, directory: str, glob: str = "*.json", parser: Parser | None = None) -> DataFrame:
    """One document per file, all sub-directories included: ``path, doc, error``.

    Every file gives one row. Files of length zero are empty documents, as are those with
    blanks or a comment only; files that cannot be read, are not UTF-8 text, or hold what has no JSON
    form have an error. Without a parser the text is JSON and is parsed on the JVM. A parser
    runs on the executors, batch by batch, and only turns text into plain values.
    """
    files = read_files(spark, directory, glob).select("path", text_of().alias("text"), problem_of().alias("error"))
    if parser is not None:
        return _with_parser(files, parser)
    parsed = compute_once(files, doc=F.try_parse_json("text"))
    broken = F.when(F.col("text").isNotNull() & F.col("doc").isNull(), F.lit(MALFORMED))
    return parsed.select("path", "doc", F.coalesce("error", broken).alias("error"))


def read_json_lines(spark: SparkSession, directory: str) -> DataFrame:
    """One document per line, splittable: ``path, doc, error``."""
    lines = spark.read.text(directory).select(F.col("_metadata.file_path").alias("path"), "value")
    return parse_documents(lines, "value").select("path", "doc", "error")


def good_documents(df: DataFrame, error: str = "error") -> DataFrame:
    return df.filter(F.col(error).isNull())


def quarantined(df: DataFrame, error: str = "error") -> DataFrame:
    return df.filter(F.col(error).isNotNull())


def drop_empty(df: DataFrame, doc: str = "doc") -> DataFrame:
    """Drop documents without content: null, {}, [], "", 0 and false."""
    return df.filter(~is_falsy(F.col(doc)))


def list_items(df: DataFrame, doc: str = "doc", keep: Sequence[str] = ()) -> DataFrame:
    """Documents that hold a list → one row per element, ``position`` from 1.

    An empty document gives no rows, and neither does one that is not a list; the latter
    is reported by ``not_lists``.
    """
    items = F.posexplode(as_elements(F.col(doc)))
    return df.select(*keep, items.alias("position", "item")).withColumn("position", F.col("position") + 1)


def not_lists(df: DataFrame, doc: str = "doc", keep: Sequence[str] = ()) -> DataFrame:
    value: Column = F.col(doc)
    return df.filter(value.isNotNull() & ~is_array(value) & ~is_null(value)).select(
        *keep, F.lower(kind(value)).alias("found"), as_text(value).alias("value")
    )


def category_of(path: Column, pattern: str = r"([^/]+)/[^/]+$", group: int = 1) -> Column:
    """Category from a path; by default the directory that holds the file."""
    return F.regexp_extract(path, pattern, group)


def census(df: DataFrame, category: Column) -> DataFrame:
    """Documents per category, counted from the path alone."""
    return df.groupBy(category.alias("category")).agg(F.count("*").alias("n_documents"))


def source_census(spark: SparkSession, directory: str, glob: str = "*.yaml") -> DataFrame:
    """Census of a directory, files of length zero included; only names are read, no content."""
    return census(read_files(spark, directory, glob, content=False), category_of(F.col("path")))


def list_documents(files: DataFrame, doc: str = "doc", error: str = "error") -> DataFrame:
    """Documents of files that hold lists: ``path, position, doc, error``, every file accounted for.

    Each element is a document. A file that could not be parsed keeps its error, one that
    is no list gets one, and an empty file or list is one empty document; these have no position.
    """
    value = F.col(doc)
    elements = F.when(F.col(error).isNull(), as_elements(value))
    wrong = F.when(~is_falsy(value) & elements.isNull(), F.concat(F.lit("not a list of documents: "), F.lower(kind(value))))
    rows = files.select("path", F.coalesce(F.col(error), wrong).alias("error"), F.posexplode_outer(elements).alias("position", "doc"))
    return rows.select("path", (F.col("position") + 1).alias("position"), "doc", "error")


def account(parsed: DataFrame, doc: str = "doc", error: str = "error") -> DataFrame:
    """One row: ``n_documents``, each in one of ``n_good, n_empty, n_quarantined``."""
    return parsed.agg(*accounts(doc, error))


def accounts(doc: str = "doc", error: str = "error") -> list[Column]:
    bad, void = F.col(error).isNotNull(), is_falsy(F.col(doc))
    return [
        F.count("*").alias("n_documents"), F.count_if(~bad & ~void).alias("n_good"),
        F.count_if(~bad & void).alias("n_empty"), F.count_if(bad).alias("n_quarantined"),
    ]
