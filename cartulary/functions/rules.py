"""Normalisation rules, in a form that serves two readings.

Called on a VARIANT a rule gives the normalised VARIANT, for publishing documents. ``read``
gives the typed value straight away, for typed tables, without rebuilding the document in
between. Rules nest like the documents: ``Fields`` for an object, ``Each`` for a list.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartulary.functions.variants import (
    as_elements,
    as_fields,
    as_text,
    as_variant,
    edit_elements,
    edit_fields,
    field,
    is_array,
    is_bool,
    is_null,
    is_number,
    is_object,
    is_string,
    keep_elements,
)


@dataclass(frozen=True, eq=False)
class Leaf:
    """Rule for one value: ``edit`` VARIANT → VARIANT, ``read`` VARIANT → typed value."""

    edit: Callable[[Column], Column]
    read: Callable[[Column], Column]

    def __call__(self, value: Column) -> Column:
        return self.edit(value)


@dataclass(frozen=True, eq=False)
class Fields:
    """Rules for the listed members of an object; others, and values of other types, stay."""

    rules: Mapping[str, Callable[[Column], Column]]

    def __call__(self, value: Column) -> Column:
        return edit_fields(value, self.rules)


@dataclass(frozen=True, eq=False)
class Each:
    """A rule for every element of a list.

    ``objects_only`` drops the other elements first; ``null_is_empty`` turns a present null
    into an empty list. An absent list stays absent.
    """

    rule: Callable[[Column], Column]
    objects_only: bool = False
    null_is_empty: bool = False

    def __call__(self, value: Column) -> Column:
        kept = keep_elements(value, is_object) if self.objects_only else value
        edited = edit_elements(kept, self.rule)
        if not self.null_is_empty:
            return edited
        empty = F.to_variant_object(F.array().cast("array<string>"))
        return F.when(is_null(value), empty).otherwise(edited)

    def elements(self, value: Column) -> Column:
        """The elements that count, as array<variant>."""
        items = as_elements(value)
        if self.objects_only:
            items = F.filter(items, is_object)
        if self.null_is_empty:
            items = F.when(is_null(value), F.array().cast("array<variant>")).otherwise(items)
        return items


def _yes_no(value: Column) -> Column:
    return F.when(as_text(value) == "true", "yes").otherwise("no")


def _token_edit(value: Column) -> Column:
    return F.when(is_bool(value), as_variant(_yes_no(value))).otherwise(value)


def _token_read(value: Column) -> Column:
    return F.when(is_string(value), as_text(value)).when(is_bool(value), _yes_no(value))


def _empty_edit(value: Column) -> Column:
    return F.when(is_null(value), as_variant(F.lit(""))).otherwise(value)


def _empty_read(value: Column) -> Column:
    return F.when(is_string(value), as_text(value)).when(is_null(value), "")


def _text_edit(value: Column) -> Column:
    return (
        F.when(is_bool(value), as_variant(_yes_no(value)))
        .when(is_null(value), as_variant(F.lit("")))
        .otherwise(value)
    )


def _text_read(value: Column) -> Column:
    return F.when(is_string(value), as_text(value)).when(is_bool(value), _yes_no(value)).when(is_null(value), "")


def _element_read(value: Column) -> Column:
    return (
        F.when(is_string(value), as_text(value))
        .when(is_bool(value), _yes_no(value))
        .otherwise(F.coalesce(as_text(value), F.lit("None")))
    )


# Boolean → "yes" / "no"; the rest, null included, stays.
bool_token = Leaf(_token_edit, _token_read)
# Present null → ""; absent stays absent.
empty_for_null = Leaf(_empty_edit, _empty_read)
# Both, for a scalar that should be text.
text_field = Leaf(_text_edit, _text_read)
# Element of a text list: boolean → "yes" / "no", null → "None" as the published data has
# it, anything else as text.
text_element = Leaf(lambda value: as_variant(_element_read(value)), _element_read)
text_list = Each(text_element)


def missing_number(mode: str = "zero") -> Leaf:
    """Null or boolean coordinate → 0.0, or null with ``mode="null"``."""
    if mode not in ("zero", "null"):
        raise ValueError(f"unknown mode: {mode}")
    zero = mode == "zero"

    def edit(value: Column) -> Column:
        default = as_variant(F.lit(0.0)) if zero else F.parse_json(F.lit("null"))
        return F.when(is_bool(value) | is_null(value), default).otherwise(value)

    def read(value: Column) -> Column:
        number = F.when(is_number(value), F.try_variant_get(value, "$", "double"))
        return number.when(is_bool(value) | is_null(value), 0.0) if zero else number

    return Leaf(edit, read)


def text_array(compat: bool = False) -> Leaf:
    """Null, text, object or list → list of text.

    An object stands for its ``id``; ``compat`` takes its keys, as the published data has
    it. Objects within a list give their ``id`` too; ``compat`` renders them as JSON text.
    """

    def element(e: Column) -> Column:
        if compat:
            return as_text(e)
        return F.when(is_object(e), as_text(field(e, "id"))).otherwise(as_text(e))

    def read(value: Column) -> Column:
        keys = F.map_keys(as_fields(value)) if compat else F.array(as_text(field(value, "id")))
        return (
            F.when(is_string(value), F.array(as_text(value)))
            .when(is_object(value), keys)
            .when(is_array(value), F.transform(as_elements(value), element))
            .when(is_null(value), F.array().cast("array<string>"))
        )

    def edit(value: Column) -> Column:
        listed = read(value)
        return F.when(listed.isNotNull(), F.to_variant_object(listed)).otherwise(value)

    return Leaf(edit, read)
