"""Compare a Spark result with the SQL result on the same tables, as bags of rows."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return value


def bags(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter, list[str], Counter]:
    names = sorted(df.columns)
    mine = Counter(tuple((type(v).__name__, _plain(v)) for v in row) for row in df.select(*names).collect())
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    order = [columns.index(c) for c in sorted(columns)]
    theirs = Counter(
        tuple((type(row[i]).__name__, _plain(row[i])) for i in order) for row in cursor.fetchall()
    )
    return names, mine, sorted(columns), theirs
