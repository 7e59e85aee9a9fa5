"""Normalisation of drifting types in documents.

A rule set for one kind of document is a plain dict from field to rule, and the whole set
runs as one projection.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.functions.rules import (
    Each,
    Fields,
    bool_token,
    missing_number,
    text_array,
    text_field,
    text_list,
)
from cartulary.functions.variants import edit_fields

Rule = Callable[[Column], Column]


def struct_list(keys: Sequence[str], rule: Rule = text_field, **options: bool) -> Each:
    """Apply a rule to the listed keys of every object in a list."""
    return Each(Fields(dict.fromkeys(keys, rule)), **options)


# Which fields of each dataset hold text, and the keys within its lists.
BLOCK_TEXT_FIELDS = [
    "id", "status", "name", "founded", "geographic_scope", "wikidata_id",
    "legal_status", "description", "dissolved", "predecessor", "successor",
]
BLOCK_LIST_KEYS = {
    "includes": ["id", "name", "type", "status", "joined", "role", "note"],
    "links": ["url", "type"],
    "other_names": ["id", "name"],
    "acronyms": ["lang", "value"],
    "topics": ["key", "name"],
}


def rules_for(dataset: str, compat: bool = False, coordinates: str = "zero") -> dict[str, Rule]:
    """Rule set of a dataset: ``countries`` (none), ``intblocks`` or ``blocktypes``."""
    if dataset == "countries":
        return {}
    if dataset == "blocktypes":
        names = struct_list(["lang", "name"], null_is_empty=True)
        return {"id": text_field, "name": text_field, "other_names": names}
    if dataset != "intblocks":
        raise ValueError(f"unknown dataset: {dataset}")
    number = missing_number(coordinates)
    rules: dict[str, Rule] = dict.fromkeys(BLOCK_TEXT_FIELDS, text_field)
    rules |= {name: struct_list(keys) for name, keys in BLOCK_LIST_KEYS.items()}
    rules["translations"] = struct_list(["lang", "name"], bool_token, objects_only=True)
    rules["languages"] = text_list
    rules["partof"] = text_array(compat)
    rules["headquarters"] = Fields(
        {"city": text_field, "country": text_field, "coordinates": Fields({"lat": number, "lng": number})}
    )
    return rules


def normalise(df: DataFrame, doc: str, rules: Mapping[str, Rule]) -> DataFrame:
    """Normalise a VARIANT document column in place, unknown fields kept."""
    return df.withColumn(doc, edit_fields(F.col(doc), rules))
