"""Queries for facets, enrichment, membership, graphs, names and evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartulary.functions.text import WHITESPACE
from cartulary.functions.variants import as_elements, as_text, field
from cartulary.operators.conform import conform
from cartulary.operators.enrich import crosswalk, dangling, enrich, resolve_codes
from cartulary.operators.evolve import generate_blocks, list_blocks, merge_members, migrate_field
from cartulary.operators.facets import daily_sketches, facets_between, array_facets, count_differences, facet_counts
from cartulary.operators.graph import ancestor_closure, edges, missing_reverse
from cartulary.operators.identity import duplicates, keep_one
from cartulary.operators.membership import (
    block_algebra,
    bridge,
    declared_pairs,
    jaccard,
    members_at,
    membership_counts,
    memberships_on_days,
    overlap,
    similar_blocks,
    with_interval,
)
from cartulary.operators.names import alias_table, localised_name, resolve_mentions
from cartulary.operators.unnest import unnest
from cartulary.plans.queries_documents import block_text, docs, order_schema, order_text
from cartulary.plans.queries_links import HREF
from cartulary.plans.registry import Tables, arr, obj, query, quote
from cartulary.schemas import block_schema
from cartulary.sources.documents import good_documents


@query(
    "d02_code_crosswalk",
    """
    SELECT c_custkey, CASE c_mktsegment WHEN 'FURNITURE' THEN NULL ELSE c_nationkey END AS n_nationkey,
           CASE c_mktsegment WHEN 'FURNITURE' THEN NULL WHEN 'BUILDING' THEN 'alpha' ELSE 'm49' END AS scheme
    FROM customer
    """,
)
def code_crosswalk(t: Tables) -> DataFrame:
    number = F.lpad(F.col("n_nationkey").cast("string"), 3, "0")
    nations = t.nation.withColumn("numeric", number).withColumn("m49", number)
    walk = crosswalk(nations, "n_nationkey", {"alpha": "n_name", "numeric": "numeric", "m49": "m49"})
    key = F.col("c_nationkey").cast("string")
    code = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("  nation_"), key, F.lit(" ")))
        .when(F.col("c_mktsegment") == "FURNITURE", "??")
        .when(F.col("c_mktsegment") == "MACHINERY", key)
        .otherwise(F.lpad(key, 3, "0"))
    )
    resolved = resolve_codes(t.customer.select("c_custkey", code.alias("code")), "code", walk, "n_nationkey")
    return resolved.select("c_custkey", "n_nationkey", "scheme")


@query(
    "d03_facet_counts",
    """
    SELECT c_nationkey, c_mktsegment, GROUPING(c_nationkey, c_mktsegment) AS level, count(*) AS n
    FROM customer GROUP BY CUBE (c_nationkey, c_mktsegment)
    """,
)
def facets_with_subtotals(t: Tables) -> DataFrame:
    return facet_counts(t.customer, ["c_nationkey", "c_mktsegment"], "cube")


@query(
    "d04_array_facets",
    r"""
    WITH w AS (
      SELECT doc_id, unnest(list_filter(string_split_regex(text, '[\s\x{1c}-\x{1f}\x{85}\p{Z}]+'), lambda x: x <> '')) AS value
      FROM documents)
    SELECT value, count(*) AS n, count(DISTINCT doc_id) AS n_documents FROM w GROUP BY value
    """,
)
def word_facets(t: Tables) -> DataFrame:
    words = F.filter(F.split("text", WHITESPACE), lambda w: w != "")
    return array_facets(t.documents, words)


@query(
    "d04_facet_sketches",
    """
    SELECT event_type AS facet, count(*) AS n, true AS within_bound FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY 1
    """,
)
def facet_sketches(t: Tables) -> DataFrame:
    """Events and different users of each type over some days, from daily sketches; estimates are held against exact counts."""
    day, first, last = F.to_date("ts"), F.lit("2024-01-05").cast("date"), F.lit("2024-01-20").cast("date")
    merged = facets_between(daily_sketches(t.events, "event_type", day, "user_id"), first, last)
    exact = t.events.filter((day >= first) & (day <= last)).groupBy(F.col("event_type").alias("facet")).agg(F.countDistinct("user_id").alias("users"))
    bound = F.abs(F.col("n_entities") - F.col("users")) <= 0.03 * F.col("users") + 1
    return merged.join(exact, "facet").select("facet", "n", bound.alias("within_bound"))


@query(
    "d05_declared_count",
    "SELECT p_partkey, CAST(p_size AS BIGINT) AS declared, CAST(2 AS BIGINT) AS actual FROM part WHERE p_size <> 2",
)
def declared_count(t: Tables) -> DataFrame:
    blocks = conform(docs(t.part, block_text(), "p_partkey"), "doc", block_schema(), keep=["p_partkey"])
    return count_differences(blocks, ["p_partkey"], F.col("membership_count"), F.col("includes"))


@query(
    "d06_unnest_filter_limit",
    """
    SELECT o_orderkey AS key, o_orderstatus AS status, o_custkey AS k, o_orderpriority AS s
    FROM orders WHERE o_orderpriority = '2-HIGH' ORDER BY 1, 3 LIMIT 50
    """,
)
def unnest_filter_limit(t: Tables) -> DataFrame:
    text = F.when(F.col("o_orderstatus").isNull(), '{"key":').otherwise(order_text())
    typed = conform(good_documents(docs(t.orders, text)), "doc", order_schema())
    return unnest(typed, ["key", "status"], "items", F.col("element.s") == "2-HIGH", ["key", "k"], 50)


@query(
    "d07_enrichment_join",
    """
    SELECT r_name, o_orderstatus, count(*) AS n_orders, count(c_custkey) AS n_matched
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
         LEFT JOIN region ON n_regionkey = r_regionkey
    GROUP BY 1, 2
    """,
)
def enrichment_join(t: Tables) -> DataFrame:
    customers = t.customer.withColumnRenamed("c_custkey", "o_custkey")
    regions = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), "r_name"
    )
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    placed = enrich(orders, customers, ["o_custkey"], ["c_nationkey"])
    per_nation = placed.groupBy("c_nationkey", "o_orderstatus").agg(
        F.count("*").alias("n_orders"), F.count_if("matched").alias("n_matched")
    )
    return (
        per_nation.join(regions, "c_nationkey", "left")
        .groupBy("r_name", "o_orderstatus")
        .agg(F.sum("n_orders").alias("n_orders"), F.sum("n_matched").alias("n_matched"))
    )


@query(
    "d08_referential_integrity",
    """
    SELECT 'documents.doc_id' AS edge, doc_id AS reference, count(*) AS n FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 2
    UNION ALL
    SELECT 'lineitem.l_partkey', l_partkey, count(*) FROM lineitem
    WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type <> 'ECONOMY') GROUP BY 2
    UNION ALL
    SELECT 'orders.o_custkey', o_custkey, count(*) FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY 2
    """,
)
def referential_integrity(t: Tables) -> DataFrame:
    current = t.part.filter(F.col("p_type") != "ECONOMY")
    checks = {
        "documents.doc_id": dangling(t.documents, "doc_id", t.labels, "doc_id"),
        "lineitem.l_partkey": dangling(t.lineitem, "l_partkey", current, "p_partkey"),
        "orders.o_custkey": dangling(t.orders, "o_custkey", t.customer, "c_custkey"),
    }
    found = None
    for edge, df in checks.items():
        named = df.select(F.lit(edge).alias("edge"), "reference", "n")
        found = named if found is None else found.unionByName(named)
    return found


def page_members(t: Tables) -> DataFrame:
    hrefs = F.regexp_extract_all("html", F.lit(HREF), F.lit(1))
    members = F.transform(hrefs, lambda h: F.struct(h.alias("member"), F.lit("link").alias("type")))
    return bridge(t.pages.select("page_id", members.alias("includes")), "page_id", "includes")


@query(
    "d09_membership_bridge",
    r"""
    SELECT page_id AS block, member, CASE WHEN member IS NOT NULL THEN 'link' END AS type
    FROM pages LEFT JOIN (
      SELECT page_id AS id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS member FROM pages) ON page_id = id
    """,
)
def membership_bridge(t: Tables) -> DataFrame:
    return page_members(t)


@query(
    "d09_blocks_per_member",
    r"""
    SELECT member, count(DISTINCT page_id) AS n_blocks
    FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS member FROM pages) GROUP BY member
    """,
)
def blocks_per_member(t: Tables) -> DataFrame:
    return membership_counts(page_members(t))


@query(
    "d10_members_at_date",
    """
    WITH m AS (
      SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_orderstatus AS st, o_orderpriority AS pr FROM orders),
    i AS (
      SELECT o_orderkey,
             CASE st WHEN 'F' THEN make_date(year(d), 1, 1) WHEN 'O' THEN make_date(year(d), month(d), 1) ELSE d END AS valid_from,
             CASE pr WHEN '5-LOW' THEN DATE '9999-12-31' WHEN '2-HIGH' THEN make_date(year(d) + 1, 12, 31)
                     ELSE last_day(d + INTERVAL 2 MONTH) END AS valid_to
      FROM m WHERE pr <> '1-URGENT')
    SELECT * FROM i WHERE DATE '1998-06-15' BETWEEN valid_from AND valid_to
    """,
)
def members_on_a_day(t: Tables) -> DataFrame:
    day, status, priority = F.to_date("o_orderdate"), F.col("o_orderstatus"), F.col("o_orderpriority")
    joined = (
        F.when(priority == "1-URGENT", "1990s")
        .when(status == "F", F.date_format(day, "yyyy"))
        .when(status == "O", F.date_format(day, "yyyy-MM"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    left = (
        F.when(priority == "2-HIGH", (F.year(day) + 1).cast("string"))
        .when(priority != "5-LOW", F.date_format(F.add_months(day, 2), "yyyy-MM"))
    )
    pairs = t.orders.select("o_orderkey", joined.alias("joined"), left.alias("left"))
    current = members_at(with_interval(pairs), F.lit("1998-06-15").cast("date"))
    return current.select("o_orderkey", "valid_from", "valid_to")


@query(
    "d10_memberships_on_days",
    """
    SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, c_mktsegment, count(*) AS n_facts
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE CAST(o_orderdate AS DATE) BETWEEN make_date(CAST(1994 + c_nationkey % 5 AS INTEGER), 1, 1)
      AND CASE WHEN c_mktsegment = 'BUILDING' THEN DATE '9999-12-31'
               ELSE make_date(CAST(1997 + c_nationkey % 5 AS INTEGER), 12, 31) END
    GROUP BY 1, 2, 3
    """,
)
def memberships_of_order_days(t: Tables) -> DataFrame:
    start = (F.lit(1994) + F.col("c_nationkey") % 5).cast("string")
    end = F.when(F.col("c_mktsegment") != "BUILDING", (F.lit(1997) + F.col("c_nationkey") % 5).cast("string"))
    intervals = with_interval(
        t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", start.alias("joined"), end.alias("left"))
    ).select("o_custkey", "c_mktsegment", "valid_from", "valid_to")
    facts = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("day"))
    found = memberships_on_days(facts, intervals, "o_custkey", "day")
    return found.select("o_custkey", "day", "c_mktsegment", "n_facts")


@query(
    "d11_missing_reverse_edges",
    """
    WITH e AS (
      SELECT DISTINCT src, dst FROM (
        SELECT p_partkey AS src, p_partkey // 2 AS dst FROM part WHERE p_size <= 40
        UNION ALL SELECT p_partkey, p_partkey * 2 FROM part
        UNION ALL SELECT p_partkey, p_partkey * 2 + 1 FROM part))
    SELECT src, dst FROM e WHERE NOT EXISTS (SELECT 1 FROM e r WHERE r.src = e.dst AND r.dst = e.src)
    """,
)
def missing_reverse_edges(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    up = F.when(F.col("p_size") <= 40, F.floor(key / 2))
    neighbours = F.array(up, key * 2, key * 2 + 1)
    return missing_reverse(edges(t.part.select(key, neighbours.alias("borders")), "p_partkey", "borders"))


@query(
    "d12_block_algebra",
    """
    SELECT l_orderkey AS member, CASE WHEN bool_or(l_returnflag = 'A') AND bool_or(l_returnflag = 'R') THEN 'both'
           WHEN bool_or(l_returnflag = 'A') THEN 'first' ELSE 'second' END AS held_by
    FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY l_orderkey
    """,
)
def algebra_of_two_blocks(t: Tables) -> DataFrame:
    pairs = t.lineitem.select(F.col("l_returnflag").alias("block"), F.col("l_orderkey").alias("member"))
    algebra = block_algebra(pairs, F.lit("A"), F.lit("R"))
    held_by = F.when(F.col("in_first") & F.col("in_second"), "both").when(F.col("in_first"), "first").otherwise("second")
    return algebra.select("member", held_by.alias("held_by"))


@query(
    "d13_block_overlap",
    """
    WITH m AS (SELECT DISTINCT l_partkey AS b, l_suppkey AS s FROM lineitem),
    n AS (SELECT b, count(*) AS n FROM m GROUP BY b),
    sh AS (
      SELECT p_partkey, count(*) AS n FROM part JOIN m x ON x.b = p_partkey JOIN m y ON y.b = p_partkey // 2 AND y.s = x.s
      GROUP BY 1),
    o AS (
      SELECT p.p_partkey AS first, p.p_partkey // 2 AS second, coalesce(a.n, 0) AS n_first, coalesce(c.n, 0) AS n_second,
             coalesce(sh.n, 0) AS n_shared
      FROM part p LEFT JOIN n a ON a.b = p.p_partkey LEFT JOIN n c ON c.b = p.p_partkey // 2
           LEFT JOIN sh ON sh.p_partkey = p.p_partkey)
    SELECT *, n_first + n_second - n_shared AS n_union,
           round(CASE WHEN n_first + n_second - n_shared > 0
                      THEN n_shared / CAST(n_first + n_second - n_shared AS DOUBLE) ELSE 0 END, 6) AS jaccard
    FROM o
    """,
)
def block_overlap(t: Tables) -> DataFrame:
    parents = t.part.select("p_partkey", F.floor(F.col("p_partkey") / 2).alias("partof"))
    pairs = t.lineitem.select(F.col("l_partkey").alias("block"), F.col("l_suppkey").alias("member"))
    compared = overlap(pairs, declared_pairs(parents, "p_partkey", "partof"))
    return compared.withColumn("jaccard", jaccard(F.col("n_shared"), F.col("n_union"))).select(
        "first", "second", "n_first", "n_second", "n_shared", "n_union", "jaccard"
    )


@query(
    "d13_similar_blocks",
    """
    WITH m AS (SELECT DISTINCT l_orderkey AS b, l_partkey AS p FROM lineitem),
    n AS (SELECT b, count(*) AS n FROM m GROUP BY b),
    s AS (SELECT x.b AS first, y.b AS second, count(*) AS n_shared FROM m x JOIN m y ON x.p = y.p AND x.b < y.b GROUP BY 1, 2)
    SELECT first, second, f.n AS n_first, g.n AS n_second, n_shared, f.n + g.n - n_shared AS n_union
    FROM s JOIN n f ON f.b = first JOIN n g ON g.b = second WHERE 2 * n_shared >= f.n + g.n - n_shared
    """,
)
def similar_orders(t: Tables) -> DataFrame:
    """Orders of which at least half the parts are the same."""
    pairs = t.lineitem.select(F.col("l_orderkey").alias("block"), F.col("l_partkey").alias("member"))
    return similar_blocks(pairs, 0.5).select("first", "second", "n_first", "n_second", "n_shared", "n_union")


@query(
    "d14_member_merge",
    """
    WITH a AS (
      SELECT DISTINCT c_nationkey AS block, l_suppkey AS member
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)
    SELECT s_nationkey AS block, s_suppkey AS member, false AS added FROM supplier
    UNION ALL
    SELECT block, member, true FROM a
    WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = block AND s_suppkey = member)
    """,
)
def member_merge(t: Tables) -> DataFrame:
    existing = t.supplier.select(F.col("s_nationkey").alias("block"), F.col("s_suppkey").alias("member"))
    orders = enrich(
        t.orders.select("o_orderkey", "o_custkey"),
        t.customer.withColumnRenamed("c_custkey", "o_custkey"),
        ["o_custkey"],
        ["c_nationkey"],
    ).select(F.col("o_orderkey").alias("l_orderkey"), F.col("c_nationkey").alias("block"))
    lines = t.lineitem.select("l_orderkey", F.col("l_suppkey").alias("member")).distinct()
    additions = lines.join(orders, "l_orderkey").filter(F.col("block").isNotNull()).select("block", "member")
    return merge_members(existing, additions)


@query(
    "d15_group_generation",
    """
    WITH r AS (
      SELECT c_nationkey AS block, c_custkey, c_name, count(*) OVER (PARTITION BY c_nationkey) AS n,
             row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey, c_name) AS place
      FROM customer)
    SELECT block, CAST((place + 9999) // 10000 AS INTEGER) AS part, CAST((n + 9999) // 10000 AS INTEGER) AS n_parts,
           n AS membership_count, string_agg(c_custkey || ':' || c_name, ',' ORDER BY c_custkey, c_name) AS includes
    FROM r GROUP BY 1, 2, 3, 4
    """,
)
def group_generation(t: Tables) -> DataFrame:
    blocks = list_blocks(generate_blocks(t.customer, "c_nationkey", "c_custkey", ["c_name"]), ["c_name"])
    listed = F.transform("includes", lambda m: F.concat(m["id"], F.lit(":"), m["c_name"]))
    return blocks.withColumn("includes", F.array_join(listed, ","))


@query(
    "d16_field_migration",
    """
    SELECT conv_id, turn, role AS name_id, text AS name, false AS has_old, turn AS kept FROM conversations
    """,
)
def field_migration(t: Tables) -> DataFrame:
    text = obj(
        turn=F.col("turn"), translations=arr(obj(lang=quote(F.col("role")), name=quote(F.col("text"))))
    )
    moved = migrate_field(docs(t.conversations, text, "conv_id", "turn"), "doc")
    doc = F.col("doc")
    first = F.get(as_elements(field(doc, "other_names")), F.lit(0))
    return moved.select(
        "conv_id",
        "turn",
        as_text(field(first, "id")).alias("name_id"),
        as_text(field(first, "name")).alias("name"),
        field(doc, "translations").isNotNull().alias("has_old"),
        as_text(field(doc, "turn")).cast("bigint").alias("kept"),
    )


@query(
    "d17_duplicate_identities",
    """
    SELECT * FROM (
      SELECT p_name, p_brand, p_partkey, count(*) OVER (PARTITION BY p_name) AS n_copies,
             row_number() OVER (PARTITION BY p_name ORDER BY p_brand, p_partkey) = 1 AS kept
      FROM part)
    WHERE n_copies > 1
    """,
)
def duplicate_identities(t: Tables) -> DataFrame:
    return duplicates(t.part.select("p_name", "p_brand", "p_partkey"), "p_name", ["p_brand", "p_partkey"])


@query(
    "d17_keep_one",
    """
    SELECT p_name, p_brand, p_partkey, p_type, p_size FROM part
    QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_brand, p_partkey) = 1
    """,
)
def keep_one_copy(t: Tables) -> DataFrame:
    rows = t.part.select("p_name", "p_brand", "p_partkey", "p_type", "p_size")
    return keep_one(rows, "p_name", ["p_brand", "p_partkey"])


@query(
    "d18_localised_name",
    """
    SELECT doc_id, CASE WHEN lang IN ('fr', 'de') THEN source ELSE 'doc ' || doc_id END AS name FROM documents
    """,
)
def name_in_language(t: Tables) -> DataFrame:
    canonical = F.concat(F.lit("doc "), F.col("doc_id"))
    names = F.array(
        F.struct(F.lit("en").alias("id"), F.lit("English").alias("name")),
        F.struct(F.col("lang").alias("id"), F.col("source").alias("name")),
        F.struct(F.col("lang").alias("id"), F.lit("again").alias("name")),
    )
    named = t.documents.select("doc_id", names.alias("other_names"), canonical.alias("canonical"))
    chosen = localised_name(F.col("other_names"), ["fr", "de"], F.col("canonical"))
    return named.select("doc_id", chosen.alias("name"))


@query(
    "d19_alias_resolution",
    r"""
    WITH a AS (
      SELECT DISTINCT page_id, array_to_string(list_filter(string_split_regex(lower(label),
               '[\s\x{1c}-\x{1f}\x{85}\p{Z}]+'), lambda x: x <> ''), ' ') AS alias
      FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1)) AS label FROM pages)),
    s AS (SELECT alias, count(*) AS n_ids, min(page_id) AS id FROM a WHERE alias <> '' GROUP BY alias),
    m AS (
      SELECT alias, count(*) AS n_mentions FROM (
        SELECT unnest(list_filter(string_split_regex(lower(text), '[\s\x{1c}-\x{1f}\x{85}\p{Z}]+'), lambda x: x <> '')) AS alias
        FROM documents) GROUP BY alias)
    SELECT m.alias, n_mentions, coalesce(n_ids, 0) AS n_ids, CASE WHEN n_ids = 1 THEN id END AS id,
           CASE WHEN n_ids IS NULL THEN 'unknown' WHEN n_ids = 1 THEN 'resolved' ELSE 'ambiguous' END AS status
    FROM m LEFT JOIN s ON m.alias = s.alias
    """,
)
def alias_resolution(t: Tables) -> DataFrame:
    labels = F.regexp_extract_all("html", F.lit('<a href="[^"]*">([^<]*)</a>'), F.lit(1))
    aliases = alias_table(t.pages, "page_id", {"name": labels})
    mentions = t.documents.select(F.explode(F.split("text", WHITESPACE)).alias("word"))
    return resolve_mentions(mentions, "word", aliases)


@query(
    "d20_ancestor_closure",
    """
    WITH RECURSIVE up(node, ancestor, depth) AS (
      SELECT p_partkey, p_partkey // 2, 1 FROM part WHERE p_partkey <> p_partkey // 2
      UNION ALL
      SELECT node, ancestor // 2, depth + 1 FROM up WHERE ancestor <> ancestor // 2)
    SELECT node, ancestor, min(depth) AS depth FROM up GROUP BY node, ancestor
    """,
)
def closure(t: Tables) -> DataFrame:
    tree = t.part.select("p_partkey", F.floor(F.col("p_partkey") / 2).alias("partof"))
    return ancestor_closure(tree, "p_partkey", "partof")
