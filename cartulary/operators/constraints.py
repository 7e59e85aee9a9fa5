"""Declared constraints on documents.

Each rule becomes a column expression that yields the places where it is broken. All
rules of a set run in one projection over one scan, and only broken places leave it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.functions.text import well_formed_url
from cartulary.functions.variants import (
    as_elements,
    as_members,
    as_text,
    field,
    is_array,
    is_bool,
    is_null,
    is_number,
    is_object,
    is_string,
    let,
)

PLACE = "struct<rule:string,path:string,position:int,value:string>"


@dataclass(frozen=True)
class Constraint:
    """``broken`` maps the VARIANT at ``path`` to a boolean.

    The path is relative to the document: ``status``, ``headquarters.city``,
    ``includes[].id``; "" is the document itself.
    """

    rule: str
    path: str
    broken: Callable[[Column], Column]
    label: str | None = None


def _number(value: Column) -> Column:
    return F.try_variant_get(value, "$", "double")


# JSON type names → test. A boolean is not a number; 3.0 is an integer.
TYPE_TESTS: dict[str, Callable[[Column], Column]] = {
    "string": is_string,
    "boolean": is_bool,
    "number": is_number,
    "integer": lambda v: is_number(v) & (_number(v) == F.floor(_number(v))),
    "object": is_object,
    "array": is_array,
    "null": is_null,
}


def has_type(value: Column, types: Sequence[str]) -> Column:
    test = F.lit(False)
    for name in types:
        test = test | TYPE_TESTS[name](value)
    return test


def required(name: str, within: str = "") -> Constraint:
    """The object at ``within`` must have the field, be it null."""
    label = f"{within}.{name}" if within else name
    return Constraint("required", within, lambda v: is_object(v) & field(v, name).isNull(), label)


def typed(path: str, *types: str) -> Constraint:
    rule = "type" if len(types) == 1 else "nullable_type" if "null" in types else "type"
    return Constraint(rule, path, lambda v: v.isNotNull() & ~has_type(v, types))


def length(path: str, at_least: int | None = None, at_most: int | None = None) -> Constraint:
    def broken(v: Column) -> Column:
        n = F.char_length(as_text(v))
        short = n < at_least if at_least is not None else F.lit(False)
        long = n > at_most if at_most is not None else F.lit(False)
        return is_string(v) & (short | long)

    return Constraint("length", path, broken)


def pattern(path: str, regex: str) -> Constraint:
    """Unanchored unless the pattern anchors itself."""
    return Constraint("pattern", path, lambda v: is_string(v) & ~as_text(v).rlike(regex))


def enum(path: str, *values: str) -> Constraint:
    return Constraint(
        "enum", path, lambda v: v.isNotNull() & ~F.coalesce(is_string(v) & as_text(v).isin(*values), F.lit(False))
    )


def min_items(path: str, n: int) -> Constraint:
    return Constraint("min_items", path, lambda v: F.size(as_elements(v)) < n)


def minimum(path: str, n: float) -> Constraint:
    return Constraint("minimum", path, lambda v: is_number(v) & (_number(v) < n))


def one_of(path: str, *branches: Callable[[Column], Column]) -> Constraint:
    """Exactly one branch must hold."""

    def broken(v: Column) -> Column:
        holding = F.lit(0)
        for branch in branches:
            holding = holding + F.coalesce(branch(v), F.lit(False)).cast("int")
        return v.isNotNull() & (holding != 1)

    return Constraint("one_of", path, broken)


def uri(path: str) -> Constraint:
    return Constraint("uri", path, lambda v: is_string(v) & ~well_formed_url(as_text(v)))


@dataclass
class _Rules:
    """The constraints of one place, and of the places below it."""

    here: list[Constraint]
    members: dict[str, _Rules]
    items: _Rules | None = None


def _tree(constraints: Sequence[Constraint]) -> _Rules:
    root = _Rules([], {})
    for c in constraints:
        node = root
        for step in re.findall(r"\[\]|[^.\[\]]+", c.path):
            if step == "[]":
                node.items = node.items or _Rules([], {})
                node = node.items
            else:
                node = node.members.setdefault(step, _Rules([], {}))
        node.here.append(c)
    return root


def _places(value: Column, rules: _Rules, position: Column | None) -> Column:
    """array<PLACE> of all rules from here down; the value is taken apart once, a list opened once."""
    none = F.array().cast(f"array<{PLACE}>")

    def report(c: Constraint, v: Column) -> Column:
        row = F.struct(
            F.lit(c.rule).alias("rule"),
            F.lit(c.path if c.label is None else c.label).alias("path"),
            (F.lit(None) if position is None else position).cast("int").alias("position"),
            as_text(v).alias("value") if c.label is None else F.lit(None).cast("string").alias("value"),
        )
        return F.when(c.broken(v), row.cast(PLACE))

    def at(v: Column) -> Column:
        parts = [F.array_compact(F.array(*[report(c, v) for c in rules.here]))] if rules.here else []
        if rules.members:
            of_members = lambda m: F.concat(*[_places(m[name], below, position) for name, below in rules.members.items()])
            parts.append(let(as_members(v, rules.members), of_members))
        if rules.items is not None:
            below = lambda e, i: _places(e, rules.items, i + 1 if position is None else position)
            parts.append(F.coalesce(F.flatten(F.transform(as_elements(v), below)), none))
        return F.concat(*parts) if len(parts) > 1 else parts[0]

    return at(value)


def check_constraints(df: DataFrame, doc: str, constraints: Sequence[Constraint], keep: Sequence[str]) -> DataFrame:
    """``keep`` + ``rule, path, position, value``: one row per broken place.

    ``position`` is the 1-based index in the outermost list of the path. Constraints are gathered
    by their paths, so that a list is opened once however many rules look into it.
    """
    if not constraints:
        raise ValueError("no constraints")
    return df.select(*keep, F.inline(_places(F.col(doc), _tree(constraints), None)))


def _accepts(schema: dict) -> Callable[[Column], Column]:
    """Boolean test of a value against a small sub-schema, for one_of branches."""

    def test(v: Column) -> Column:
        types = schema.get("type", [])
        types = [types] if isinstance(types, str) else types
        ok = has_type(v, types) if types else F.lit(True)
        for name in schema.get("required", []):
            ok = ok & (~is_object(v) | field(v, name).isNotNull())
        for name, sub in schema.get("properties", {}).items():
            member = field(v, name)
            ok = ok & (member.isNull() | _accepts(sub)(member))
        if "items" in schema:
            every = F.forall(as_elements(v), _accepts(schema["items"]))
            ok = ok & (~is_array(v) | every)
        return ok

    return test


def from_json_schema(schema: dict, path: str = "") -> list[Constraint]:
    """Constraints of a draft-07 JSON Schema document (a parsed dict).

    Covers required, type, enum, minLength/maxLength, pattern, minItems, minimum, oneOf,
    format uri and the nesting keywords properties and items.
    """
    found: list[Constraint] = []
    if "type" in schema and path:
        types = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
        found.append(typed(path, *types))
    if "enum" in schema:
        found.append(enum(path, *schema["enum"]))
    if "minLength" in schema or "maxLength" in schema:
        found.append(length(path, schema.get("minLength"), schema.get("maxLength")))
    if "pattern" in schema:
        found.append(pattern(path, schema["pattern"]))
    if "minItems" in schema:
        found.append(min_items(path, schema["minItems"]))
    if "minimum" in schema:
        found.append(minimum(path, schema["minimum"]))
    if schema.get("format") == "uri":
        found.append(uri(path))
    if "oneOf" in schema:
        found.append(one_of(path, *[_accepts(branch) for branch in schema["oneOf"]]))
    found += [required(name, path) for name in schema.get("required", [])]
    for name, sub in schema.get("properties", {}).items():
        found += from_json_schema(sub, f"{path}.{name}" if path else name)
    if "items" in schema:
        found += from_json_schema(schema["items"], f"{path}[]")
    return found
