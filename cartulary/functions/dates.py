"""Partial dates: YYYY, YYYY-MM or YYYY-MM-DD held as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a year, a month or a day.
PARTIAL_DATE = r"^[0-9]{4}(-[0-9]{2}(-[0-9]{2})?)?$"


def first_day(text: Column) -> Column:
    """Earliest day the partial date can mean; NULL when it is not a date."""
    return F.when(
        text.rlike(PARTIAL_DATE),
        F.when(F.length(text) == 4, F.concat(text, F.lit("-01-01")))
        .when(F.length(text) == 7, F.concat(text, F.lit("-01")))
        .otherwise(text)
        .try_cast("date"),
    )


def last_day(text: Column) -> Column:
    """Latest day the partial date can mean; NULL when it is not a date."""
    return F.when(
        text.rlike(PARTIAL_DATE),
        F.when(F.length(text) == 4, F.concat(text, F.lit("-12-31")).try_cast("date"))
        .when(F.length(text) == 7, F.last_day(F.concat(text, F.lit("-01")).try_cast("date")))
        .otherwise(text.try_cast("date")),
    )


def is_partial_date(text: Column) -> Column:
    return first_day(text).isNotNull()
