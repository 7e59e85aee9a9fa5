"""Column helpers over VARIANT values.

Three states must stay apart: an absent field is SQL NULL, a field that is present
with a JSON null is a variant null, and anything else is a value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = Callable[[Column], Column]

_WHOLE_OR_BINARY = ("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE")


def field(value: Column, *names: str) -> Column:
    """The named member as VARIANT; SQL NULL when it (or any parent) is absent."""
    path = "$" + "".join(f"['{name}']" for name in names)
    return F.try_variant_get(value, path, "variant")


def kind(value: Column) -> Column:
    """BOOLEAN, STRING, BIGINT, DECIMAL, DOUBLE, OBJECT, ARRAY or VOID."""
    return F.substring_index(F.substring_index(F.schema_of_variant(value), "<", 1), "(", 1)


def is_bool(value: Column) -> Column:
    return F.schema_of_variant(value) == "BOOLEAN"


def is_string(value: Column) -> Column:
    return F.schema_of_variant(value) == "STRING"


def is_number(value: Column) -> Column:
    schema = F.schema_of_variant(value)
    return schema.isin(*_WHOLE_OR_BINARY) | schema.startswith("DECIMAL")


def is_object(value: Column) -> Column:
    return as_fields(value).isNotNull()


def is_array(value: Column) -> Column:
    return as_elements(value).isNotNull()


def is_null(value: Column) -> Column:
    """Present and JSON null."""
    return F.is_variant_null(value)


def is_present(value: Column) -> Column:
    """Present with something other than JSON null."""
    return value.isNotNull() & ~F.is_variant_null(value)


def as_text(value: Column) -> Column:
    """Scalars as plain text, objects and arrays as JSON text."""
    return F.try_variant_get(value, "$", "string")


def as_elements(value: Column) -> Column:
    """array<variant>, or NULL when the value is not an array."""
    return value.try_cast("array<variant>")


def as_fields(value: Column) -> Column:
    """map<string,variant>, or NULL when the value is not an object."""
    return value.try_cast("map<string,variant>")


def as_members(value: Column, names: Iterable[str]) -> Column:
    """struct<name:variant, …> of an object in one pass, or NULL when it is not one."""
    inner = ",".join(f"`{name}`:variant" for name in names)
    return F.try_variant_get(value, "$", f"struct<{inner}>")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, also inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def as_variant(value: Column) -> Column:
    return value.cast("variant")


# Texts of the values other than strings that count as nothing.
_NOTHING = r"^(false|\[\]|\{\}|-?0+(\.0*)?(E[+-]?[0-9]+)?)$"


def _is_nothing(value: Column, text: Column) -> Column:
    return F.coalesce((text == "") | (~is_string(value) & text.rlike(_NOTHING)), F.lit(True))


def is_falsy(value: Column) -> Column:
    """Absent, null, false, zero, "" or an empty object or array.

    Objects are judged by their size, so a large document is not rendered as text.
    """
    fields = as_fields(value)
    return F.when(fields.isNotNull(), F.size(fields) == 0).otherwise(_is_nothing(value, as_text(value)))


def truthy_text(value: Column) -> Column:
    """Text of the value, or "" when it is absent or falsy."""
    text = as_text(value)
    return F.when(_is_nothing(value, text), F.lit("")).otherwise(text)


def edit_fields(value: Column, rules: Mapping[str, Rule]) -> Column:
    """Rewrite the listed members of an object; other members, and non-objects, stay.

    Names with the same rule share one branch.
    """
    if not rules:
        return value
    names_of: dict[Rule, list[str]] = {}
    for name, rule in rules.items():
        names_of.setdefault(rule, []).append(name)

    def rewrite(name: Column, member: Column) -> Column:
        edited = F
        for rule, names in names_of.items():
            edited = edited.when(name.isin(*names), rule(member))
        return edited.otherwise(member)

    return F.coalesce(F.to_variant_object(F.transform_values(as_fields(value), rewrite)), value)


def edit_elements(value: Column, rule: Rule) -> Column:
    """Rewrite every element of an array; a value that is not an array stays."""
    return F.coalesce(F.to_variant_object(F.transform(as_elements(value), rule)), value)


def keep_elements(value: Column, predicate: Rule) -> Column:
    """Keep the elements of an array that satisfy the predicate."""
    return F.coalesce(F.to_variant_object(F.filter(as_elements(value), predicate)), value)
