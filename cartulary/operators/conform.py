"""Conform documents to a declared nested schema.

One projection per dataset: declared fields in declared order, absent → null, unknown
fields dropped at every depth. Values are taken over by JSON type, not by what a cast
would let through: a quoted number is not a number.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartulary.functions.plan import compute_once
from cartulary.functions.rules import Each, Fields, Leaf
from cartulary.functions.variants import (
    Rule,
    as_elements,
    as_fields,
    as_members,
    as_text,
    is_bool,
    is_number,
    is_present,
    is_string,
    kind,
    let,
)

_FIELDS, _EDITED = "_fields", "_edited"
VIOLATION = "struct<path:string,position:int,expected:string,found:string,value:string,issue:string>"


def _number(value: Column, dtype: T.DataType) -> Column:
    return F.try_variant_get(value, "$", dtype.simpleString())


def _leaf(value: Column, dtype: T.DataType, mode: str) -> Column:
    if isinstance(dtype, T.StringType):
        return F.when(is_string(value), as_text(value))
    if isinstance(dtype, T.BooleanType):
        return F.when(is_bool(value), F.try_variant_get(value, "$", "boolean"))
    if isinstance(dtype, (T.LongType, T.DoubleType)):
        taken = F.when(is_number(value), _number(value, dtype))
        if mode == "compat" and isinstance(dtype, T.DoubleType):
            taken = taken.when(is_bool(value), F.when(as_text(value) == "true", 1.0).otherwise(0.0))
        return taken
    raise TypeError(f"no conform rule for {dtype.simpleString()}")


def _type_name(dtype: T.DataType) -> str:
    return "object" if isinstance(dtype, (T.StructType, T.MapType)) else dtype.typeName()


def conform_value(
    value: Column, dtype: T.DataType, mode: str = "permissive", path: str = "$", rule: Rule | None = None
) -> Column:
    """Typed column for a VARIANT, read through a rule if there is one.

    In strict mode a mismatch raises when the row is read. A rule may turn a mismatch into
    null on purpose, so strict mode looks at the normalised value.
    """
    if rule is not None and (mode == "strict" or not isinstance(rule, (Leaf, Fields, Each))):
        return conform_value(rule(value), dtype, mode, path)
    if isinstance(rule, Leaf):
        return rule.read(value)
    if isinstance(dtype, T.StructType):
        inner = rule.rules if isinstance(rule, Fields) else {}

        def struct(m: Column) -> Column:
            typed = [
                conform_value(m[f.name], f.dataType, mode, f"{path}.{f.name}", inner.get(f.name)).alias(f.name)
                for f in dtype.fields
            ]
            return F.when(m.isNotNull(), F.struct(*typed))

        typed = let(as_members(value, dtype.names), struct)
    elif isinstance(dtype, T.ArrayType):
        items = rule.elements(value) if isinstance(rule, Each) else as_elements(value)
        inner_rule = rule.rule if isinstance(rule, Each) else None
        typed = F.transform(
            items, lambda e: conform_value(e, dtype.elementType, mode, f"{path}[]", inner_rule)
        )
    elif isinstance(dtype, T.MapType):
        typed = F.transform_values(
            as_fields(value), lambda _, e: conform_value(e, dtype.valueType, mode, f"{path}.*")
        )
    else:
        typed = _leaf(value, dtype, mode)
    if mode != "strict":
        return typed
    problem = F.concat(
        F.lit(f"{path}: expected {_type_name(dtype)}, found "), kind(value), F.lit(": "), as_text(value)
    )
    return F.coalesce(typed, F.when(is_present(value), F.raise_error(problem).cast(dtype)))


def _edited(rules: Mapping[str, Rule], name: str) -> Column:
    value = F.col(_FIELDS)[name]
    return rules[name](value) if name in rules else value


def _fields(df: DataFrame, doc: str, schema: T.StructType) -> DataFrame:
    """Add the declared fields as one struct of VARIANTs."""
    return compute_once(df, **{_FIELDS: as_members(F.col(doc), schema.names)})


def conform(
    df: DataFrame,
    doc: str,
    schema: T.StructType,
    mode: str = "permissive",
    rules: Mapping[str, Rule] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Select ``keep`` and the declared fields of the document column.

    ``rules`` normalises each field on the way.
    Modes: ``permissive`` (mismatch → null), ``compat`` (booleans count as doubles too)
    and ``strict`` (mismatch fails the job).
    """
    if mode not in ("permissive", "compat", "strict"):
        raise ValueError(f"unknown mode: {mode}")
    rules = rules or {}
    columns = [
        conform_value(F.col(_FIELDS)[f.name], f.dataType, mode, f.name, rules.get(f.name)).alias(f.name)
        for f in schema.fields
    ]
    return _fields(df, doc, schema).select(*keep, *columns)


def _fits(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return is_string(value)
    if isinstance(dtype, T.BooleanType):
        return is_bool(value)
    return is_number(value)


def mismatches(value: Column, dtype: T.DataType, path: str, position: Column | None = None) -> Column:
    """array<struct> of the places where a VARIANT does not fit the declared type."""
    none = F.array().cast(f"array<{VIOLATION}>")
    at = F.lit(None).cast("int") if position is None else position

    def report(issue: str) -> Column:
        row = F.struct(
            F.lit(path).alias("path"),
            at.alias("position"),
            F.lit(_type_name(dtype)).alias("expected"),
            F.lower(kind(value)).alias("found"),
            as_text(value).alias("value"),
            F.lit(issue).alias("issue"),
        )
        return F.array(row.cast(VIOLATION))

    def container(content: Column, places: Callable[[Column], Column], null_fits: bool = True) -> Column:
        wrong = is_present(value) if null_fits else value.isNotNull()

        def inner(c: Column) -> Column:
            return F.when(c.isNotNull(), places(c)).when(wrong, report("type")).otherwise(none)

        return F.when(value.isNull(), none).otherwise(let(content, inner))

    if isinstance(dtype, T.StructType):
        return container(
            as_members(value, dtype.names),
            lambda m: F.concat(
                *[mismatches(m[f.name], f.dataType, f"{path}.{f.name}", position) for f in dtype.fields]
            ),
        )
    if isinstance(dtype, T.ArrayType):

        def element(e: Column, i: Column) -> Column:
            return mismatches(e, dtype.elementType, f"{path}[]", i + 1 if position is None else position)

        # a list that is present but null comes out as null, which is a change of its own
        return container(as_elements(value), lambda items: F.flatten(F.transform(items, element)), null_fits=False)
    if isinstance(dtype, T.MapType):
        return container(
            as_fields(value),
            lambda items: F.flatten(
                F.transform(F.map_values(items), lambda e: mismatches(e, dtype.valueType, f"{path}.*", position))
            ),
        )
    found = F.when(is_present(value) & ~_fits(value, dtype), report("type"))
    if isinstance(dtype, T.LongType):
        exact = F.try_variant_get(value, "$", "double")
        found = found.when(is_number(value) & (exact != F.floor(exact)), report("lossy"))
    return found.otherwise(none)


def violations(
    df: DataFrame,
    doc: str,
    schema: T.StructType,
    rules: Mapping[str, Rule] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per value that ``conform`` turned into null or cut to fit."""
    edited = F.struct(*[_edited(rules or {}, name).alias(name) for name in schema.names])
    normal = compute_once(_fields(df, doc, schema), **{_EDITED: edited})
    parts = [mismatches(F.col(_EDITED)[f.name], f.dataType, f.name) for f in schema.fields]
    return normal.select(*keep, F.inline(F.concat(*parts)))


def infer_schema(df: DataFrame, doc: str) -> DataFrame:
    """One row with the merged schema observed over all documents."""
    return df.agg(F.schema_of_variant_agg(F.col(doc)).alias("observed_schema"))
