"""Queries for the declared constraints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartulary.functions.variants import is_array, is_null, is_object, is_string
from cartulary.operators.constraints import (
    check_constraints,
    enum,
    length,
    min_items,
    minimum,
    one_of,
    pattern,
    required,
    typed,
    uri,
)
from cartulary.plans.queries_documents import docs
from cartulary.plans.registry import Tables, arr, obj, query, quote


@query(
    "s01_required",
    """
    SELECT d.doc_id, 'required' AS rule, 'quality' AS path, CAST(NULL AS INTEGER) AS position,
           CAST(NULL AS VARCHAR) AS value
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL
    """,
)
def required_field(t: Tables) -> DataFrame:
    joined = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    text = obj(lang=quote(F.col("lang")), quality=F.col("quality"))
    return check_constraints(docs(joined, text, "doc_id"), "doc", [required("lang"), required("quality")], ["doc_id"])


@query(
    "s02_required_in_element",
    """
    SELECT o_orderkey, 'required' AS rule, 'items[].s' AS path, 2 AS position, CAST(NULL AS VARCHAR) AS value
    FROM orders WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT o_orderkey, 'required', 'seat.city', NULL, NULL FROM orders WHERE o_orderpriority = '2-HIGH'
    """,
)
def required_in_element(t: Tables) -> DataFrame:
    second = obj(k=F.col("o_custkey"), s=F.when(F.col("o_orderstatus") != "F", quote(F.col("o_orderstatus"))))
    seat = obj(city=F.when(F.col("o_orderpriority") != "2-HIGH", quote(F.col("o_orderpriority"))))
    text = obj(items=arr(obj(k=F.lit("1"), s=F.lit("null")), second), seat=seat)
    rules = [required("s", "items[]"), required("city", "seat")]
    return check_constraints(docs(t.orders, text, "o_orderkey"), "doc", rules, ["o_orderkey"])


@query(
    "s03_type",
    """
    SELECT p_partkey, 'type' AS rule, 'name' AS path, CAST(NULL AS INTEGER) AS position,
           CASE WHEN p_type = 'SMALL' THEN 'false' ELSE CAST(p_size AS VARCHAR) END AS value
    FROM part WHERE p_type IN ('SMALL', 'PROMO')
    UNION ALL
    SELECT p_partkey, 'type', 'count', NULL, p_size || '.5' FROM part WHERE p_size > 25
    """,
)
def type_of_field(t: Tables) -> DataFrame:
    kind = F.col("p_type")
    name = (
        F.when(kind == "SMALL", "false")
        .when(kind == "PROMO", F.col("p_size").cast("string"))
        .otherwise(quote(F.col("p_name")))
    )
    count = F.when(F.col("p_size") > 25, F.concat(F.col("p_size"), F.lit(".5"))).otherwise(
        F.concat(F.col("p_size"), F.lit(".0"))
    )
    rules = [typed("name", "string"), typed("count", "integer")]
    return check_constraints(docs(t.part, obj(name=name, count=count), "p_partkey"), "doc", rules, ["p_partkey"])


@query(
    "s04_length",
    """
    SELECT p_partkey, 'length' AS rule, 'brand' AS path, CAST(NULL AS INTEGER) AS position, p_brand AS value
    FROM part WHERE length(p_brand) NOT BETWEEN 8 AND 8
    """,
)
def text_length(t: Tables) -> DataFrame:
    parsed = docs(t.part, obj(brand=quote(F.col("p_brand"))), "p_partkey")
    return check_constraints(parsed, "doc", [length("brand", 8, 8)], ["p_partkey"])


@query(
    "s05_pattern",
    """
    SELECT o_orderkey, 'pattern' AS rule, 'priority' AS path, CAST(NULL AS INTEGER) AS position,
           o_orderpriority AS value
    FROM orders WHERE NOT regexp_matches(o_orderpriority, '^[1-3]-[A-Z]+$')
    """,
)
def text_pattern(t: Tables) -> DataFrame:
    parsed = docs(t.orders, obj(priority=quote(F.col("o_orderpriority"))), "o_orderkey")
    return check_constraints(parsed, "doc", [pattern("priority", "^[1-3]-[A-Z]+$")], ["o_orderkey"])


@query(
    "s06_enum",
    """
    SELECT event_id, 'enum' AS rule, 'type' AS path, CAST(NULL AS INTEGER) AS position, event_type AS value
    FROM events WHERE event_type NOT IN ('view', 'click', 'purchase')
    """,
)
def enumeration(t: Tables) -> DataFrame:
    parsed = docs(t.events, obj(type=quote(F.col("event_type"))), "event_id")
    return check_constraints(parsed, "doc", [enum("type", "view", "click", "purchase")], ["event_id"])


@query(
    "s07_min_items",
    r"""
    SELECT page_id, 'min_items' AS rule, 'hrefs' AS path, CAST(NULL AS INTEGER) AS position,
           '[' || array_to_string(list_transform(hrefs, lambda h: '"' || h || '"'), ',') || ']' AS value
    FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS hrefs FROM pages)
    WHERE len(hrefs) < 6
    """,
)
def minimum_items(t: Tables) -> DataFrame:
    hrefs = F.regexp_extract_all("html", F.lit(r'href="([^"]*)"'), F.lit(1))
    parsed = docs(t.pages, obj(hrefs=F.to_json(hrefs)), "page_id")
    return check_constraints(parsed, "doc", [min_items("hrefs", 6)], ["page_id"])


@query(
    "s08_minimum",
    """
    SELECT c_custkey, 'minimum' AS rule, 'balance' AS path, CAST(NULL AS INTEGER) AS position,
           CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) AS value
    FROM customer WHERE floor(c_acctbal) < 1000
    """,
)
def minimum_value(t: Tables) -> DataFrame:
    parsed = docs(t.customer, obj(balance=F.floor("c_acctbal")), "c_custkey")
    return check_constraints(parsed, "doc", [minimum("balance", 1000)], ["c_custkey"])


@query(
    "s09_nullable_type",
    """
    SELECT o_orderkey, 'nullable_type' AS rule, 'joined' AS path, CAST(NULL AS INTEGER) AS position,
           CAST(year(o_orderdate) AS VARCHAR) AS value
    FROM orders WHERE o_orderstatus = 'O'
    """,
)
def nullable_type(t: Tables) -> DataFrame:
    status, year = F.col("o_orderstatus"), F.year("o_orderdate").cast("string")
    joined = F.when(status == "F", "null").when(status == "O", year).otherwise(quote(year))
    parsed = docs(t.orders, obj(joined=joined), "o_orderkey")
    return check_constraints(parsed, "doc", [typed("joined", "string", "null")], ["o_orderkey"])


@query(
    "s10_one_of",
    """
    SELECT p_partkey, 'one_of' AS rule, 'partof' AS path, CAST(NULL AS INTEGER) AS position,
           '["' || p_brand || '"]' AS value
    FROM part WHERE p_type = 'LARGE'
    UNION ALL
    SELECT p_partkey, 'one_of', 'partof', NULL, CAST(p_size AS VARCHAR) FROM part WHERE p_type = 'STANDARD'
    """,
)
def one_of_shapes(t: Tables) -> DataFrame:
    kind, brand = F.col("p_type"), quote(F.col("p_brand"))
    shape = (
        F.when(kind == "ECONOMY", "null")
        .when(kind == "PROMO", brand)
        .when(kind == "SMALL", obj(id=brand))
        .when(kind == "LARGE", arr(brand))
        .when(kind == "STANDARD", F.col("p_size").cast("string"))
    )
    objects = lambda v: is_array(v) & F.forall(v.try_cast("array<variant>"), is_object)
    rule = one_of("partof", is_object, objects, is_string, is_null)
    return check_constraints(docs(t.part, obj(partof=shape), "p_partkey"), "doc", [rule], ["p_partkey"])


@query(
    "s11_uri",
    r"""
    WITH links AS (
      SELECT page_id, url, regexp_extract_all(html, 'href="([^"]*)"', 1) AS hrefs FROM pages)
    SELECT page_id, 'uri' AS rule, path, CAST(position AS INTEGER) AS position, value
    FROM (SELECT page_id, 'url' AS path, NULL AS position, url AS value FROM links
          UNION ALL SELECT page_id, 'hrefs[]', generate_subscripts(hrefs, 1), unnest(hrefs) FROM links)
    WHERE regexp_extract(value, '^([A-Za-z][A-Za-z0-9+.-]*):', 1) = ''
       OR regexp_extract(value, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1) = ''
    """,
)
def uri_format(t: Tables) -> DataFrame:
    hrefs = F.array_join(F.transform(F.regexp_extract_all("html", F.lit(r'href="([^"]*)"'), F.lit(1)), quote), ",")
    parsed = docs(t.pages, obj(url=quote(F.col("url")), hrefs=F.concat(F.lit("["), hrefs, F.lit("]"))), "page_id")
    return check_constraints(parsed, "doc", [uri("url"), uri("hrefs[]")], ["page_id"])
