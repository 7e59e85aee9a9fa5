"""Text predicates: URLs, entity ids, names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns: what counts as a scheme, an authority and an entity id.
SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"
AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"
ENTITY_ID = r"(Q[0-9]+)"
ENTITY_ID_FORMAT = r"^Q[0-9]+$"
# Unicode white space, including the information separators.
WHITESPACE = r"[\s\x1c-\x1f\x85\p{Z}]+"


def well_formed_url(url: Column) -> Column:
    """True when the URL has both a scheme and an authority."""
    return (F.regexp_extract(url, SCHEME, 1) != "") & (F.regexp_extract(url, AUTHORITY, 1) != "")


def entity_id(url: Column) -> Column:
    """First entity id anywhere in the URL, NULL when there is none."""
    return F.nullif(F.regexp_extract(url, ENTITY_ID, 1), F.lit(""))


def valid_entity_id(value: Column) -> Column:
    return value.rlike(ENTITY_ID_FORMAT)


def words(text: Column) -> Column:
    """Lower-case words separated by white space."""
    return F.filter(F.split(F.lower(text), WHITESPACE), lambda w: w != "")


def squeeze(text: Column) -> Column:
    """Lower case with white space collapsed to single blanks."""
    return F.array_join(words(text), " ")


def similar_names(name: Column, label: Column) -> Column:
    """Equal, one within the other, or more than 3/10 of the larger word set shared.

    A missing or empty label cannot be compared and counts as similar. The ratio is
    compared in whole numbers, so that exactly 3/10 is refused.
    """
    a, b = squeeze(name), squeeze(label)
    shared = F.size(F.array_intersect(words(name), words(label)))
    larger = F.greatest(F.size(F.array_distinct(words(name))), F.size(F.array_distinct(words(label))))
    return (
        F.when(label.isNull() | (label == ""), True)
        .when(a == b, True)
        .when(F.contains(b, a) | F.contains(a, b), True)
        .otherwise(shared * 10 > larger * 3)
    )


def quoted_list(items: Column) -> Column:
    """['a', 'b'] as used in finding messages."""
    return F.concat(F.lit("['"), F.array_join(items, "', '"), F.lit("']"))
