"""Registry of demonstration queries, one per operator, with equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}
_MODULES = ("documents", "constraints", "links", "relations", "publishing")


class Tables:
    """The parquet tables of one directory, read on access."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self._directory = directory.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self._directory}/{name}.parquet")


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a query under ``name``, with the SQL that must give the same rows."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in _QUERIES:
            raise ValueError(f"registered twice: {name}")
        _QUERIES[name] = lambda spark, directory: build(Tables(spark, directory))
        if sql is not None:
            _SQL[name] = sql
        return build

    return register


def _load() -> None:
    for module in _MODULES:
        import_module(f"cartulary.plans.queries_{module}")


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)


def quote(text: Column) -> Column:
    """Text as a JSON string."""
    return F.to_json(text.cast("string").cast("variant"))


def _text(value: Column | str) -> Column:
    return F.lit(value) if isinstance(value, str) else value.cast("string")


def obj(**members: Column | str) -> Column:
    """JSON object text from member texts; a NULL member is absent, 'null' is present."""
    parts = [F.concat(F.lit(f'"{name}":'), _text(value)) for name, value in members.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def arr(*items: Column | str) -> Column:
    """JSON array text from element texts."""
    return F.concat(F.lit("["), F.concat_ws(",", *[_text(item) for item in items]), F.lit("]"))
