"""Unnest, filter, first rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(
    df: DataFrame,
    keep: Sequence[str],
    elements: str,
    where: Column | None = None,
    order_by: Sequence[str] = (),
    limit: int | None = None,
) -> DataFrame:
    """Explode an array of structs beside ``keep``, filter, and take the first rows in order.

    The element fields are available as ``element.<field>`` to ``where`` and appear in the
    result under their own names.
    """
    rows = df.select(*keep, F.explode(elements).alias("element"))
    if where is not None:
        rows = rows.filter(where)
    rows = rows.select(*keep, "element.*")
    if limit is None:
        return rows
    if not order_by:
        raise ValueError("a limit needs an order, or the result depends on the partitioning")
    return rows.orderBy(*order_by).limit(limit)
