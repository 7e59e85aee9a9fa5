"""Members of blocks: bridge table, as-of membership, set algebra and overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartulary.functions.dates import first_day, last_day
from cartulary.session import enable_checkpoints


def bridge(df: DataFrame, block: str, members: str) -> DataFrame:
    """One row per block and listed member; a block without members keeps one row."""
    return df.select(F.col(block).alias("block"), F.inline_outer(members))


def blocks_of_members(pairs: DataFrame, block: str = "block", member: str = "member") -> DataFrame:
    """The inverse in long form: distinct ``member, block``."""
    return pairs.filter(F.col(member).isNotNull()).select(member, block).distinct()


def membership_counts(pairs: DataFrame, block: str = "block", member: str = "member") -> DataFrame:
    """``member, n_blocks``: distinct pairs first, so a hot member is combined early."""
    return blocks_of_members(pairs, block, member).groupBy(member).agg(F.count("*").alias("n_blocks"))


def with_interval(pairs: DataFrame, joined: str = "joined", left: str = "left") -> DataFrame:
    """Widen partial dates to ``valid_from``, ``valid_to``; an absent end is open.

    ``date_fault`` marks text that is no date. Such an end is unknown, not open: the row
    gets no interval.
    """
    start, end = F.col(joined), F.col(left)
    fault = (start.isNotNull() & first_day(start).isNull()) | (end.isNotNull() & last_day(end).isNull())
    return (
        pairs.withColumn("date_fault", fault)
        .withColumn("valid_from", F.when(~fault, F.coalesce(first_day(start), F.lit("0001-01-01").cast("date"))))
        .withColumn("valid_to", F.when(~fault, F.coalesce(last_day(end), F.lit("9999-12-31").cast("date"))))
    )


def members_at(intervals: DataFrame, day: Column) -> DataFrame:
    """Memberships in force on a day."""
    return intervals.filter((F.col("valid_from") <= day) & (day <= F.col("valid_to")))


def memberships_on_days(facts: DataFrame, intervals: DataFrame, member: str, day: str) -> DataFrame:
    """Memberships in force for each member on each day it occurs in ``facts``.

    Facts are counted per member and day first (``n_facts``), so a hot member brings no
    more rows than the calendar has days. An interval goes to each year it touches, of those
    that the facts span, and meets the days of that year only: a member with many days and
    many intervals does not multiply them. Days at an interval's ends are checked on the joined row.
    """
    days = facts.filter(F.col(day).isNotNull()).groupBy(member, day).agg(F.count("*").alias("n_facts"))
    first, last = (facts.agg(F.year(f(day))).scalar() for f in (F.min, F.max))
    lo, hi = F.greatest(F.year("valid_from"), first), F.least(F.year("valid_to"), last)
    yearly = intervals.withColumn("_year", F.explode(F.when(lo <= hi, F.sequence(lo, hi))))
    joined = days.withColumn("_year", F.year(day)).join(yearly, [member, "_year"]).drop("_year")
    return joined.filter((F.col("valid_from") <= F.col(day)) & (F.col(day) <= F.col("valid_to")))


def block_algebra(pairs: DataFrame, first: Column, second: Column, block: str = "block", member: str = "member") -> DataFrame:
    """Members of two blocks with ``in_first``, ``in_second``.

    One aggregate serves intersection, union and both differences.
    """
    chosen = pairs.filter((F.col(block) == first) | (F.col(block) == second))
    return chosen.groupBy(member).agg(
        F.max(F.col(block) == first).alias("in_first"), F.max(F.col(block) == second).alias("in_second")
    )


def intersection(algebra: DataFrame) -> DataFrame:
    return algebra.filter(F.col("in_first") & F.col("in_second")).drop("in_first", "in_second")


def union(algebra: DataFrame) -> DataFrame:
    return algebra.drop("in_first", "in_second")


def difference(algebra: DataFrame) -> DataFrame:
    return algebra.filter(F.col("in_first") & ~F.col("in_second")).drop("in_first", "in_second")


def overlap(pairs: DataFrame, compare: DataFrame, block: str = "block", member: str = "member") -> DataFrame:
    """Shared members of the block pairs in ``compare``: ``first, second``.

    Adds ``n_first, n_second, n_shared, n_union``. The pairs to compare are data, such as
    the edges of a hierarchy: the members of the smaller block of each pair are looked up
    in the other, so the work is the sum of the smaller sizes and no member fans out to
    all pairs of its blocks. Hot blocks and hot members are split at run time. Members and sizes are
    read several times and therefore written to the checkpoint folder.
    """
    enable_checkpoints(pairs.sparkSession)
    members = (
        pairs.select(F.col(block).alias("_block"), F.col(member).alias("_member"))
        .filter(F.col("_block").isNotNull() & F.col("_member").isNotNull())
        .distinct()
        .checkpoint()
    )
    sizes = members.groupBy("_block").agg(F.count("*").alias("_size"))

    def with_size(df: DataFrame, side: str) -> DataFrame:
        named = sizes.select(F.col("_block").alias(side), F.col("_size").alias(f"n_{side}"))
        return df.join(named, side, "left").fillna(0, [f"n_{side}"])

    sized = with_size(with_size(compare.select("first", "second").distinct(), "first"), "second").checkpoint()
    first_smaller = F.col("n_first") <= F.col("n_second")
    driven = sized.select(
        F.when(first_smaller, F.col("first")).otherwise(F.col("second")).alias("_block"),
        F.when(first_smaller, F.col("second")).otherwise(F.col("first")).alias("_other"),
        "first",
        "second",
    )
    candidates = members.join(driven, "_block")
    looked_up = members.select(F.col("_block").alias("_other"), "_member")
    shared = (
        candidates.join(looked_up, ["_other", "_member"], "left_semi")
        .groupBy("first", "second")
        .agg(F.count("*").alias("n_shared"))
    )
    return (
        sized.join(shared, ["first", "second"], "left")
        .fillna(0, ["n_shared"])
        .withColumn("n_union", F.col("n_first") + F.col("n_second") - F.col("n_shared"))
    )


def signature(member: Column) -> Column:
    """Aggregate: 64 bits, one set for each member by its hash; sets differ in at least as many members as bits."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(member), F.lit(64)).cast("int")))


def similar_pairs(pairs: DataFrame, least: float, block: str = "block", member: str = "member") -> DataFrame:
    """Pairs of different blocks, ``first < second``, that may reach a Jaccard similarity of ``least``: none is missed.

    Members are ordered by how many rows name them. Blocks that are similar share one
    of the first, rarest few members of each: of ``n`` members the first ``n - ceil(least * n) + 1``.
    Only these are joined, and only blocks whose sizes and signatures allow the similarity, so pairs that
    share a member and little else end within the join. A member that
    very many blocks have comes last, and is compared where blocks hold little else.
    """
    rows = pairs.select(F.col(block).alias("_block"), F.col(member).alias("_member"))
    rows = rows.filter(F.col("_block").isNotNull() & F.col("_member").isNotNull())
    rarity = rows.groupBy("_member").agg(F.count("*").alias("_rows"))
    # each row moves once by its member and once by its block, where copies of it go
    members = rows.join(rarity, "_member").repartition("_block").distinct()
    whole = Window.partitionBy("_block")
    by_rarity = whole.orderBy("_rows", "_member")
    # a margin against rounding: a longer prefix loses nothing
    kept = F.col("_size") - F.ceil(F.col("_size") * least - 1e-9) + 1
    ranked = members.select(
        "_block", "_member",
        F.row_number().over(by_rarity).alias("_rank"), F.count("*").over(whole).alias("_size"), signature(F.col("_member")).over(whole).alias("_bits"),
    )
    prefix = ranked.filter(F.col("_rank") <= kept)
    left = prefix.select("_member", F.col("_block").alias("first"), F.col("_size").alias("_n"), F.col("_rank").alias("_i"), F.col("_bits").alias("_a"))
    right = prefix.select("_member", F.col("_block").alias("second"), F.col("_size").alias("_m"), F.col("_rank").alias("_j"), F.col("_bits").alias("_b"))
    n, m = F.col("_n"), F.col("_m")
    # what can be shared from this member on, against what the similarity asks for; and what it lets differ
    rest = F.least(n - F.col("_i"), m - F.col("_j")) + F.least("_i", "_j")
    fits = (F.least(n, m) + 1e-9 >= F.greatest(n, m) * least) & (rest + 1e-9 >= (n + m) * (least / (1 + least)))
    near = F.bit_count(F.col("_a").bitwiseXOR(F.col("_b"))) <= (n + m) * ((1 - least) / (1 + least)) + 1e-9
    return left.join(right, "_member").filter((F.col("first") < F.col("second")) & fits & near).select("first", "second").distinct()


def similar_blocks(pairs: DataFrame, least: float, block: str = "block", member: str = "member") -> DataFrame:
    """All pairs of blocks with a Jaccard similarity of at least ``least``, as ``overlap`` gives them.

    ``least`` is above 0: blocks that share nothing are not found. The candidates are compared
    exactly, from the smaller block of each; only the members of their blocks are looked at again.
    """
    if not 0 < least <= 1:
        raise ValueError(f"no similarity: {least}")
    enable_checkpoints(pairs.sparkSession)
    candidates = similar_pairs(pairs, least, block, member).checkpoint()
    asked = candidates.select(F.explode(F.array("first", "second")).alias(block)).distinct()
    found = overlap(pairs.join(asked, block, "left_semi"), candidates, block, member)
    return found.filter(F.col("n_shared") + 1e-9 >= F.col("n_union") * least)


def jaccard(shared: Column, total: Column, digits: int = 6) -> Column:
    return F.round(F.when(total > 0, shared / total).otherwise(F.lit(0.0)), digits)


def declared_pairs(df: DataFrame, first: str, second: str) -> DataFrame:
    return df.select(F.col(first).alias("first"), F.col(second).alias("second"))
