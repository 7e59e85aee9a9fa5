"""Evolution of the data set: merging members, generating blocks, moving fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartulary.functions.variants import as_elements, as_fields, edit_elements, field, is_object
from cartulary.session import enable_checkpoints

PART_MEMBERS = 10_000


def merge_members(existing: DataFrame, additions: DataFrame, keys: Sequence[str] = ("block", "member")) -> DataFrame:
    """Add the members that a block lacks; running it again adds nothing.

    Works on the long table and compares whole pairs, so large blocks spread. ``added``
    marks the new rows.
    """
    keys = list(keys)
    new = additions.dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti")
    return existing.withColumn("added", F.lit(False)).unionByName(
        new.withColumn("added", F.lit(True)), allowMissingColumns=True
    )


def generate_blocks(df: DataFrame, attribute: str, member: str, fields: Sequence[str] = ()) -> DataFrame:
    """Blocks from an attribute in long form: ``block, member``, the fields, ``membership_count``.

    One row a member at any size of a block, so that no task gathers a block; the counts are
    combined early, and where a block is hot its rows are split at run time.
    """
    rows = df.filter(F.col(attribute).isNotNull()).select(F.col(attribute).alias("block"), F.col(member).alias("member"), *fields)
    return rows.join(rows.groupBy("block").agg(F.count("*").alias("membership_count")), "block")


def list_blocks(blocks: DataFrame, fields: Sequence[str] = (), size: int = PART_MEMBERS) -> DataFrame:
    """Generated blocks with their members listed: ``block, part, n_parts, membership_count, includes``.

    ``includes`` has the members (``id``, the fields) in their order. A block of over ``size`` members has
    several rows, of consecutive members, which together hold all of them. Rows are dealt by ranges of
    block and member and numbered within these, so that no task gathers a block.
    """
    enable_checkpoints(blocks.sparkSession)
    order = ["member", *fields]
    dealt = blocks.repartitionByRange("block", *order).withColumn("_range", F.spark_partition_id()).checkpoint()
    sizes = dealt.groupBy("block", "_range").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("block").orderBy("_range")  # a row for each range of a block
    before = sizes.select("block", "_range", (F.sum("_n").over(earlier) - F.col("_n")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("block", "_range").orderBy(*order)) + F.col("_before")
    placed = dealt.join(before, ["block", "_range"]).withColumn("part", F.ceil(place / size).cast("int"))
    includes = F.sort_array(F.collect_list(F.struct(F.col("member").alias("id"), *fields)))
    listed = placed.groupBy("block", "part", "membership_count").agg(includes.alias("includes"))
    n_parts = F.ceil(F.col("membership_count") / size).cast("int")
    return listed.select("block", "part", n_parts.alias("n_parts"), "membership_count", "includes")


def migrate_field(
    df: DataFrame,
    doc: str,
    old: str = "translations",
    new: str = "other_names",
    rename: tuple[str, str] = ("lang", "id"),
) -> DataFrame:
    """Move a list of objects to another field, one of its keys renamed.

    Documents that have the new field already keep it. The old field is dropped. Other
    fields stay as they are.
    """
    source, target = rename

    def renamed(element: Column) -> Column:
        members = as_fields(element)
        others = F.map_filter(members, lambda k, _: k != source)
        moved = F.when(
            F.map_contains_key(members, source),
            F.map_concat(others, F.create_map(F.lit(target), field(element, source))),
        ).otherwise(members)
        return F.when(is_object(element), F.to_variant_object(moved)).otherwise(element)

    value = F.col(doc)
    members = as_fields(value)
    kept = F.map_filter(members, lambda k, _: k != old)
    old_list = field(value, old)
    moves = as_elements(old_list).isNotNull() & field(value, new).isNull()
    moved = F.map_concat(kept, F.create_map(F.lit(new), edit_elements(old_list, renamed)))
    return df.withColumn(doc, F.to_variant_object(F.when(moves, moved).otherwise(kept)))
