from __future__ import annotations

import random
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from cartulary.functions.dates import first_day, is_partial_date, last_day
from cartulary.operators.enrich import crosswalk, dangling, enrich, resolve_codes
from cartulary.operators.evolve import generate_blocks, merge_members, migrate_field
from cartulary.operators.facets import array_facets, count_differences, daily_sketches, facets_between
from cartulary.operators.graph import ancestor_closure, edges, missing_reverse
from cartulary.operators.identity import duplicates, keep_one
from cartulary.operators.membership import (
    block_algebra,
    bridge,
    difference,
    intersection,
    members_at,
    memberships_on_days,
    overlap,
    similar_blocks,
    similar_pairs,
    union,
    with_interval,
)
from cartulary.operators.names import alias_table, localised_name, resolve_mentions
from cartulary.operators.unnest import unnest
from cartulary.plans.registry import queries


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, another third without a key."""
    rng = random.Random(7)
    keys = [1] * 400 + [None] * 400 + [rng.randrange(2, 40) for _ in range(400)]
    facts = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, v int").repartition(5)
    lookup = spark.createDataFrame([(k, f"n{k}") for k in range(0, 30)] + [(1, "again")], "k int, name string")
    return facts, lookup


def test_enrich_keeps_unmatched(spark, skewed):
    facts, lookup = skewed
    rows = enrich(facts, lookup.dropDuplicates(["k"]), ["k"], ["name"])
    assert rows.count() == facts.count()
    assert rows.filter("not matched and name is not null").count() == 0
    assert {r.k for r in rows.filter("not matched").collect()} >= {None, 30}


def test_dangling_counts_references(spark, skewed):
    facts, lookup = skewed
    found = dangling(facts, "k", lookup, "k")
    expected = Counter(r.k for r in facts.collect() if r.k is not None and r.k >= 30)
    assert {r.reference: r.n for r in found.collect()} == dict(expected)


def test_ambiguous_codes_stay_unresolved(spark):
    dim = spark.createDataFrame([("AA", "007", "x"), ("BB", "008", "AA")], "code string, num string, alt string")
    walk = crosswalk(dim, "code", {"alpha": "code", "numeric": "num", "alt": "alt"})
    facts = spark.createDataFrame([(1, "7"), (2, " bb"), (3, "aa"), (4, "zz"), (5, None)], "i int, raw string")
    rows = resolve_codes(facts, "raw", walk, "code").orderBy("i").collect()
    assert [(r.code, r.scheme) for r in rows] == [
        ("AA", "numeric"), ("BB", "alpha"), (None, None), (None, None), (None, None),
    ]


def test_partial_dates(spark):
    texts = ["1999", "1999-02", "2000-02", "1999-02-03", "1990s", "1999-13", "1999-02-30", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(first_day(F.col("t")), last_day(F.col("t")), is_partial_date(F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [
        (date(1999, 1, 1), date(1999, 12, 31), True),
        (date(1999, 2, 1), date(1999, 2, 28), True),
        (date(2000, 2, 1), date(2000, 2, 29), True),
        (date(1999, 2, 3), date(1999, 2, 3), True),
        (None, None, False), (None, None, False), (None, None, False), (None, None, False), (None, None, False),
    ]


def test_members_at_a_date(spark):
    rows = [("a", None, None), ("b", "1999", "2001-02"), ("c", "2001-03", None), ("d", "1990s", None), ("e", None, "2001-02-28")]
    spans = with_interval(spark.createDataFrame(rows, "member string, joined string, left string"))
    now = members_at(spans, F.lit("2001-02-28").cast("date"))
    assert {r.member for r in now.collect()} == {"a", "b", "e"}
    assert {r.member for r in spans.filter("date_fault").collect()} == {"d"}


def test_memberships_on_days(spark):
    spans = with_interval(
        spark.createDataFrame([("a", "X", "1999", "2000"), ("a", "Y", "2000-06", None)], "m string, b string, joined string, left string")
    ).select("m", "b", "valid_from", "valid_to")
    days = [("a", "1998-01-01"), ("a", "1999-05-05"), ("a", "2000-07-01"), ("a", "2000-07-01"), ("z", "2000-07-01")]
    facts = spark.createDataFrame(days, "m string, d string").withColumn("d", F.col("d").cast("date"))
    found = memberships_on_days(facts, spans, "m", "d").select("b", F.col("d").cast("string"), "n_facts")
    assert bag(found) == Counter([("X", "1999-05-05", 1), ("X", "2000-07-01", 2), ("Y", "2000-07-01", 2)])


def test_bridge_keeps_empty_blocks(spark):
    df = spark.createDataFrame(
        [("A", [("x", "m"), ("y", "o")]), ("B", [])], "block string, includes array<struct<member:string,status:string>>"
    )
    assert bag(bridge(df, "block", "includes")) == Counter([("A", "x", "m"), ("A", "y", "o"), ("B", None, None)])


def test_block_algebra(spark):
    pairs = spark.createDataFrame(
        [("A", 1), ("A", 2), ("A", 2), ("B", 2), ("B", 3), ("C", 9)], "block string, member int"
    )
    algebra = block_algebra(pairs, F.lit("A"), F.lit("B"))
    sets = [{r.member for r in op(algebra).collect()} for op in (intersection, union, difference)]
    assert sets == [{2}, {1, 2, 3}, {1}]


def test_overlap_equals_brute_force(spark):
    rng = random.Random(3)
    pairs = [("hot", m) for m in range(60)] + [(f"b{rng.randrange(8)}", rng.randrange(60)) for _ in range(150)]
    compare = [("hot", f"b{i}") for i in range(8)] + [("b1", "b2"), ("b3", "b3"), ("none", "b1")]
    members = {}
    for block, member in pairs:
        members.setdefault(block, set()).add(member)
    found = overlap(
        spark.createDataFrame(pairs, "block string, member int"), spark.createDataFrame(compare, "first string, second string")
    )
    for r in found.collect():
        a, b = members.get(r.first, set()), members.get(r.second, set())
        assert (r.n_first, r.n_second, r.n_shared, r.n_union) == (len(a), len(b), len(a & b), len(a | b))
    assert found.count() == len(compare)


@pytest.mark.parametrize("least", [1.0, 0.5, 0.34])
def test_similar_blocks_equal_all_pairs(spark, least):
    rng = random.Random(9)
    blocks = {i: {min(int(rng.expovariate(0.05)), 60) for _ in range(rng.randint(1, 9))} for i in range(120)}
    blocks |= {200: blocks[3], 201: set(range(40)), 202: set(range(41))}
    rows = [(b, m) for b, ms in blocks.items() for m in ms for _ in range(rng.randint(1, 2))] + [(None, 1), (5, None)]
    pairs = spark.createDataFrame(rows, "block long, member long")
    found = {(r.first, r.second): (r.n_shared, r.n_union) for r in similar_blocks(pairs, least).collect()}
    expected = {}
    for a in blocks:
        for b in blocks:
            shared, total = len(blocks[a] & blocks[b]), len(blocks[a] | blocks[b])
            if a < b and shared >= least * total:
                expected[a, b] = (shared, total)
    assert found == expected


def test_few_pairs_are_candidates(spark):
    """A member that all blocks have makes no candidates: 400 blocks would give 79,800 pairs."""
    rows = [(b, m) for b in range(400) for m in (-1, 10 * b, 10 * b + 1, 10 * b + 2, 10 * (b // 2) + 7)]
    pairs = spark.createDataFrame(rows, "block long, member long")
    assert similar_pairs(pairs, 0.6).count() <= 400


def test_pairs_that_share_one_member_are_no_candidates(spark):
    """400 blocks of four members out of 100: thousands of pairs share one, few could share half."""
    rng = random.Random(5)
    blocks = {b: set(rng.sample(range(100), 4)) for b in range(400)}
    pairs = spark.createDataFrame([(b, m) for b, ms in blocks.items() for m in ms], "block long, member long")
    similar = {(a, b) for a in blocks for b in blocks if a < b and len(blocks[a] & blocks[b]) >= 3}
    found = {tuple(r) for r in similar_pairs(pairs, 0.6).collect()}
    assert similar <= found and len(found) < 400


def test_days_and_intervals_do_not_multiply(spark):
    """A member with 3,650 days and 200 intervals of some days, two of them open: rows meet within their year only."""
    days = spark.range(3650).selectExpr("1 AS m", "date_add(DATE '2000-01-01', CAST(id AS INT)) AS day", "id").repartition(4)
    rows = [(1, i, date(2000 + i % 10, 1 + i % 12, 1), date(2000 + i % 10, 1 + i % 12, 9)) for i in range(198)]
    rows += [(1, 198, date(1, 1, 1), date(2001, 6, 30)), (1, 199, date(2008, 2, 1), date(9999, 12, 31)), (1, 200, date(1990, 1, 1), date(1990, 2, 1)), (1, 201, None, None)]
    intervals = spark.createDataFrame(rows, "m long, i int, valid_from date, valid_to date")
    found = memberships_on_days(days, intervals, "m", "day")
    expected = sum(max(0, (min(to, date(2009, 12, 28)) - max(start, date(2000, 1, 1))).days + 1) for _, _, start, to in rows if start)
    assert found.count() == expected
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_year" in text and "CartesianProduct" not in text
    met = days.withColumn("y", F.year("day")).join(intervals.withColumn("y", F.explode(F.expr("CASE WHEN greatest(year(valid_from), 2000) <= least(year(valid_to), 2009) THEN sequence(greatest(year(valid_from), 2000), least(year(valid_to), 2009)) END"))), ["m", "y"]).count()
    assert met < 3650 * 202 / 8


def test_edges_and_missing_reverse(spark):
    df = spark.createDataFrame([("a", ["b", "c", "c"]), ("b", ["a"]), ("c", None)], "n string, borders array<string>")
    edge = edges(df, "n", "borders")
    assert edge.count() == 3
    assert bag(missing_reverse(edge)) == Counter([("a", "c")])


def test_closure_with_loops_and_dangling_parents(spark):
    rows = [("a", "b"), ("b", "c"), ("c", "c"), ("x", "y"), ("y", "z"), ("z", "x"), ("p", "missing"), ("q", None), ("d", "b"), ("d", "a")]
    found = ancestor_closure(spark.createDataFrame(rows, "id string, partof string"), "id", "partof")
    assert bag(found) == Counter(
        [
            ("a", "b", 1), ("a", "c", 2), ("b", "c", 1), ("d", "a", 1), ("d", "b", 1), ("d", "c", 2),
            ("x", "y", 1), ("x", "z", 2), ("y", "z", 1), ("y", "x", 2), ("z", "x", 1), ("z", "y", 2), ("p", "missing", 1),
        ]
    )


def test_closure_fails_rather_than_stop_short(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(6)], "id int, partof int")
    found = ancestor_closure(chain, "id", "partof", max_depth=6)
    assert bag(found) == Counter((i, j, j - i) for i in range(6) for j in range(i + 1, 7))
    with pytest.raises(ValueError, match="deeper than 5"):
        ancestor_closure(chain, "id", "partof", max_depth=5)


def test_duplicates(spark):
    rows = [("ASF", "bank", "p1"), ("ASF", "military", "p2"), ("X", "bank", "p3"), (None, "a", "p4"), (None, "b", "p5")]
    df = spark.createDataFrame(rows, "id string, category string, path string")
    found = {(r.path, r.n_copies, r.kept) for r in duplicates(df, "id", ["category", "path"]).collect()}
    assert found == {("p1", 2, True), ("p2", 2, False)}
    assert {r.path for r in keep_one(df, "id", ["category", "path"]).collect()} == {"p1", "p3", "p4"}
    assert keep_one(df, "id", ["category"]).columns == df.columns


def test_localised_names(spark):
    rows = [(1, [("fr", "un"), ("fr", "deux"), ("de", "eins")], "one"), (2, [("de", "zwei")], "two"), (3, [], "three"), (4, None, "four")]
    df = spark.createDataFrame(rows, "i int, names array<struct<id:string,name:string>>, canonical string")
    chosen = df.orderBy("i").select(localised_name(F.col("names"), ["fr", "de"], F.col("canonical"))).collect()
    assert [r[0] for r in chosen] == ["un", "zwei", "three", "four"]


def test_aliases(spark):
    df = spark.createDataFrame(
        [("US", "United  States", ["America"]), ("AM", "Armenia", ["america", None]), ("XX", " ", None)],
        "id string, name string, common array<string>",
    )
    aliases = alias_table(df, "id", {"name": F.array("name"), "common_names": F.col("common")})
    assert bag(aliases) == Counter(
        [("united states", "US", "name"), ("america", "US", "common_names"), ("armenia", "AM", "name"), ("america", "AM", "common_names")]
    )
    mentions = spark.createDataFrame([("AMERICA",), ("america",), ("Armenia ",), ("elsewhere",), ("",)], "m string")
    rows = {r.alias: (r.n_mentions, r.n_ids, r.id, r.status) for r in resolve_mentions(mentions, "m", aliases).collect()}
    assert rows == {
        "america": (2, 2, None, "ambiguous"), "armenia": (1, 1, "AM", "resolved"), "elsewhere": (1, 0, None, "unknown"),
    }


def test_array_facets(spark):
    df = spark.createDataFrame([(["a", "b", "a"],), (["a", None],), ([],), (None,)], "tags array<string>")
    assert bag(array_facets(df, F.col("tags"))) == Counter([("a", 3, 2), ("b", 1, 1), (None, 1, 1)])


def test_daily_sketches_are_united(spark):
    """Days stored one by one give the same as all days at once, within the sketch's error of exact counts."""
    rows = spark.range(60_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('f', id % 7) END AS facet", "date_add(DATE '2024-01-01', CAST(id % 10 AS INT)) AS day", "id * 7919 % 20000 AS user")
    stored = daily_sketches(rows, "facet", F.col("day"), "user")
    first, last = F.lit("2024-01-02").cast("date"), F.lit("2024-01-06").cast("date")
    found = {r.facet: (r.n, r.n_entities) for r in facets_between(stored, first, last).collect()}
    exact = {r.facet: (r.n, r.u) for r in rows.filter(F.col("day").between(first, last)).groupBy("facet").agg(F.count("*").alias("n"), F.countDistinct("user").alias("u")).collect()}
    assert found.keys() == exact.keys()
    for facet, (n, users) in exact.items():
        assert found[facet][0] == n and abs(found[facet][1] - users) <= 0.03 * users
    assert stored.agg(F.max(F.length("entities"))).first()[0] < 40_000


def test_count_differences(spark):
    df = spark.createDataFrame([(1, 2, [1, 2]), (2, 3, [1]), (3, 1, None), (4, None, [1])], "i int, n int, m array<int>")
    assert bag(count_differences(df, ["i"], F.col("n"), F.col("m"))) == Counter([(2, 3, 1), (3, 1, 0)])


def test_merge_is_idempotent(spark):
    have = spark.createDataFrame([("A", 1), ("A", 2)], "block string, member int")
    more = spark.createDataFrame([("A", 2), ("A", 3), ("A", 3), ("B", 1)], "block string, member int")
    once = merge_members(have, more)
    assert bag(once) == Counter([("A", 1, False), ("A", 2, False), ("A", 3, True), ("B", 1, True)])
    assert merge_members(once.drop("added"), more).filter("added").count() == 0


def test_generated_blocks_hold_every_member_at_any_size(spark):
    rows = spark.range(20_001).selectExpr("'big' AS region", "id AS code", "id % 3 AS x").unionByName(
        spark.createDataFrame([("small", 1, 0), (None, 2, 0), ("small", 1, 0)], "region string, code long, x long")
    )
    blocks = generate_blocks(rows, "region", "code", ["x"])
    assert blocks.columns == ["block", "member", "x", "membership_count"]
    counts = {r.block: (r.n, r.m, r.c) for r in blocks.groupBy("block").agg(F.count("*").alias("n"), F.max("membership_count").alias("m"), F.countDistinct("member").alias("c")).collect()}
    assert counts == {"big": (20_001, 20_001, 20_001), "small": (2, 2, 1)}


def test_listed_blocks_hold_their_members_in_order(spark, tmp_path):
    """The list of a block, in parts of 10,000 where it is longer."""
    customers = spark.range(20_001).selectExpr("20000 - id AS c_custkey", "concat('n', id) AS c_name", "1 AS c_nationkey").unionByName(
        spark.createDataFrame([(7, "b", 2), (5, "a", 2), (5, "a", 2), (1, "z", None)], "c_custkey long, c_name string, c_nationkey int")
    )
    customers.repartition(5).write.parquet(str(tmp_path / "customer.parquet"))
    rows = queries()["d15_group_generation"](spark, str(tmp_path)).collect()
    found = {(r.block, r.part, r.n_parts, r.membership_count): r.includes.split(",") for r in rows}
    every = [f"{i}:n{20000 - i}" for i in range(20_001)]
    assert found == {
        (1, 1, 3, 20_001): every[:10_000], (1, 2, 3, 20_001): every[10_000:20_000], (1, 3, 3, 20_001): every[20_000:],
        (2, 1, 1, 3): ["5:a", "5:a", "7:b"],
    }


def test_field_migration(documents):
    parsed = documents(
        '{"id":1,"translations":[{"lang":"en","name":"x","z":1},"bare"]}',
        '{"id":2,"translations":[{"lang":"en"}],"other_names":[{"id":"fr"}]}',
        '{"id":3}',
        '{"id":4,"translations":null}',
    )
    rows = [r[0] for r in migrate_field(parsed, "doc").select(F.to_json("doc")).collect()]
    assert rows == [
        '{"id":1,"other_names":[{"id":"en","name":"x","z":1},"bare"]}',
        '{"id":2,"other_names":[{"id":"fr"}]}',
        '{"id":3}',
        '{"id":4}',
    ]


def test_unnest_needs_an_order_for_its_limit(spark):
    df = spark.createDataFrame([(1, [("en", "x"), ("fr", "y")])], "i int, names array<struct<id:string,name:string>>")
    assert bag(unnest(df, ["i"], "names", F.col("element.id") == "en")) == Counter([(1, "en", "x")])
    with pytest.raises(ValueError):
        unnest(df, ["i"], "names", limit=5)
