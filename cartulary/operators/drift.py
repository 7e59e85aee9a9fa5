"""Drift report: what documents contain against what is declared."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartulary.functions.variants import kind
from cartulary.session import enable_checkpoints

FIRST_DEPTH = 4


def declared_paths(dtype: T.DataType, path: str = "") -> list[str]:
    """Paths of a schema in the notation of the report: ``a.b``, ``list[].c``; a key of a map is ``*``."""
    if isinstance(dtype, T.StructType):
        found = []
        for f in dtype.fields:
            name = f"{path}.{f.name}" if path else f.name
            found += [name, *declared_paths(f.dataType, name)]
        return found
    if isinstance(dtype, T.ArrayType):
        return [f"{path}[]", *declared_paths(dtype.elementType, f"{path}[]")]
    if isinstance(dtype, T.MapType):
        return [f"{path}.*", *declared_paths(dtype.valueType, f"{path}.*")]
    return []


def observed_paths(df: DataFrame, doc: str, depth: int | None = None) -> DataFrame:
    """``path, type, n`` over all documents and levels, in one scan with map-side counts.

    With a ``depth`` a container there is itself reported, its content is not. Without, levels
    are unfolded until nothing is cut off: ``FIRST_DEPTH`` of them, then twice as many, so that
    documents of usual depth are read once, and of depth d about log2(d / FIRST_DEPTH) times more.
    The counts, a row for each path and type, are then written to the checkpoint folder.
    """
    if depth is not None:
        return _paths(df, doc, depth).drop("cut")
    enable_checkpoints(df.sparkSession)
    depth = FIRST_DEPTH
    while True:
        found = _paths(df, doc, depth).checkpoint()
        if not found.agg(F.max("cut")).first()[0]:
            return found.drop("cut")
        depth *= 2


def _paths(df: DataFrame, doc: str, depth: int) -> DataFrame:
    """``path, type, n, cut``: counts to a depth, and whether a container stood there.

    Every level unfolds the members of the level above, so that a row is a leaf with the
    path that leads to it. A container is counted on the row of its first descendant.
    """
    unfold = df.sparkSession.tvf.variant_explode_outer
    rows = df.select(F.lit("").alias("_path_0"), F.col(doc).alias("_value_0"))
    for n in range(1, depth + 1):
        above, key = F.col(f"_path_{n - 1}"), F.col(f"_key_{n}")
        path = (
            F.when(F.col(f"_pos_{n}").isNull(), None)
            .when(key.isNull(), F.concat(above, F.lit("[]")))
            .when(above == "", key)
            .otherwise(F.concat(above, F.lit("."), key))
        )
        rows = (
            rows.lateralJoin(unfold(F.col(f"_value_{n - 1}").outer()))
            .withColumnsRenamed({name: f"_{name}_{n}" for name in ("pos", "key", "value")})
            .withColumn(f"_path_{n}", path)
        )
    entries = []
    first = F.lit(True)
    for n in range(depth, 0, -1):
        kind_here = kind(F.col(f"_value_{n}"))
        if n < depth:
            below, key = F.col(f"_pos_{n + 1}"), F.col(f"_key_{n + 1}")
            kind_here = F.when(below.isNull(), kind_here).when(key.isNull(), "ARRAY").otherwise("OBJECT")
        seen = F.col(f"_path_{n}").isNotNull() & first
        cut = kind_here.isin("OBJECT", "ARRAY") if n == depth else F.lit(False)
        entries.append(F.when(seen, F.struct(F.col(f"_path_{n}").alias("path"), kind_here.alias("type"), cut.alias("cut"))))
        first = first & (F.coalesce(f"_pos_{n}", F.lit(0)) == 0)
    found = rows.select(F.inline(F.array(*entries))).filter(F.col("path").isNotNull())
    return found.groupBy("path", "type").agg(F.count("*").alias("n"), F.max("cut").alias("cut"))


def drift(df: DataFrame, doc: str, schema: T.StructType, depth: int | None = None) -> DataFrame:
    """Observed paths that the schema does not declare.

    The declared paths come from the schema object, so they travel as literals.
    """
    declared = declared_paths(schema)
    known = F.col("path").isin([p for p in declared if "*" not in p])
    for path in declared:
        if "*" in path:
            known = known | F.col("path").rlike("^" + r"[^.\[\]]+".join(map(re.escape, path.split("*"))) + "$")
    return observed_paths(df, doc, depth).filter(~known)
