"""Queries for sources, normalisation and conforming.

The documents are JSON text made from whole tables, so that every case a rule knows
occurs: booleans among text, present nulls, absent fields, several shapes of one field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartulary.functions.rules import (
    bool_token,
    empty_for_null,
    missing_number,
    text_array,
    text_field,
    text_list,
)
from cartulary.functions.variants import as_elements, as_text, edit_fields, field, is_null, is_object
from cartulary.operators.conform import conform, infer_schema, violations
from cartulary.operators.drift import drift
from cartulary.operators.normalize import normalise, rules_for, struct_list
from cartulary.plans.registry import Tables, arr, obj, query, quote
from cartulary.schemas import legacy_schema
from cartulary.sources.documents import (
    category_of,
    census,
    drop_empty,
    good_documents,
    list_items,
    not_lists,
    parse_documents,
    quarantined,
)
from cartulary.sources.legacy import flatten_records

NULL = "null"


def docs(df: DataFrame, text: Column, *keep: str) -> DataFrame:
    return parse_documents(df.select(*keep, text.alias("text")), "text").drop("text")


@query(
    "r01_document_scan",
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
    """,
)
def document_scan(t: Tables) -> DataFrame:
    parsed = docs(t.events, F.col("props"), "event_id")
    return good_documents(parsed).select("event_id", as_text(field(F.col("doc"), "k")).cast("bigint").alias("k"))


@query(
    "r02_bad_document_isolation",
    """
    WITH t AS (
      SELECT event_id,
             CASE WHEN event_type = 'error' THEN regexp_replace(props, '}$', '') ELSE props END AS body
      FROM events)
    SELECT event_id, body, 'malformed document' AS error FROM t WHERE NOT json_valid(body)
    """,
)
def bad_document_isolation(t: Tables) -> DataFrame:
    body = F.when(F.col("event_type") == "error", F.regexp_replace("props", "\\}$", "")).otherwise(F.col("props"))
    return quarantined(parse_documents(t.events.select("event_id", body.alias("body")), "body")).drop("doc")


@query(
    "r03_empty_document_drop",
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k
    FROM events WHERE event_type NOT IN ('signup', 'view', 'click')
    """,
)
def empty_document_drop(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    text = (
        F.when(kind == "signup", "{}").when(kind == "view", "null").when(kind == "click", "[]").otherwise(F.col("props"))
    )
    kept = drop_empty(docs(t.events, text, "event_id"))
    return kept.select("event_id", as_text(field(F.col("doc"), "k")).cast("bigint").alias("k"))


@query(
    "r04_list_document_scan",
    """
    WITH listed AS (
      SELECT * FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW'))
    SELECT o_orderkey, 1 AS position, o_orderkey AS k, o_orderstatus AS s, NULL AS found FROM listed
    UNION ALL
    SELECT o_orderkey, 2, o_custkey, o_orderpriority, NULL FROM listed
    UNION ALL
    SELECT o_orderkey, NULL, NULL, NULL, 'object' FROM orders WHERE o_orderpriority = '5-LOW'
    """,
)
def list_document_scan(t: Tables) -> DataFrame:
    first = obj(k=F.col("o_orderkey"), s=quote(F.col("o_orderstatus")))
    second = obj(k=F.col("o_custkey"), s=quote(F.col("o_orderpriority")))
    text = (
        F.when(F.col("o_orderpriority") == "1-URGENT", NULL)
        .when(F.col("o_orderpriority") == "5-LOW", first)
        .otherwise(arr(first, second))
    )
    parsed = docs(t.orders, text, "o_orderkey")
    items = list_items(parsed, keep=["o_orderkey"]).select(
        "o_orderkey",
        "position",
        as_text(field(F.col("item"), "k")).cast("bigint").alias("k"),
        as_text(field(F.col("item"), "s")).alias("s"),
    )
    return items.unionByName(not_lists(parsed, keep=["o_orderkey"]).drop("value"), allowMissingColumns=True)


@query(
    "r05_source_census",
    """
    SELECT regexp_extract(url, '^[a-z]+://[^/]+/([a-z]+)', 1) AS category, count(*) AS n_documents
    FROM pages GROUP BY 1
    """,
)
def source_census(t: Tables) -> DataFrame:
    return census(t.pages, category_of(F.col("url"), "^[a-z]+://[^/]+/([a-z]+)"))


@query(
    "d01_legacy_records",
    """
    SELECT 'rec' || c_custkey AS id, '2020-10-21T21:40:25.000Z' AS created_time, c_name AS name_en,
           lower(c_mktsegment) AS devtype, 'rec' || c_nationkey AS countries,
           CASE WHEN c_acctbal >= 0 THEN 'yes' ELSE 'no' END AS islocal
    FROM customer
    """,
)
def legacy_records(t: Tables) -> DataFrame:
    record = obj(
        id=quote(F.concat(F.lit("rec"), F.col("c_custkey"))),
        createdTime=F.lit('"2020-10-21T21:40:25.000Z"'),
        fields=obj(
            nameEN=quote(F.col("c_name")),
            devtype=quote(F.lower("c_mktsegment")),
            country=arr(quote(F.concat(F.lit("rec"), F.col("c_nationkey")))),
            islocal=F.when(F.col("c_acctbal") >= 0, '"yes"').otherwise('"no"'),
        ),
    )
    records = t.customer.select(F.from_json(record, legacy_schema()).alias("r")).select("r.*")
    return flatten_records(records).select(
        "id",
        F.col("createdTime").alias("created_time"),
        F.col("nameEN").alias("name_en"),
        "devtype",
        F.array_join("country", ",").alias("countries"),
        "islocal",
    )


@query(
    "r06_boolean_token",
    """
    SELECT doc_id, CASE WHEN quality = 0 THEN CAST(toxic AS VARCHAR) WHEN toxic = 1 THEN 'yes' ELSE 'no' END AS toxic
    FROM labels
    """,
)
def boolean_token(t: Tables) -> DataFrame:
    toxic = F.when(F.col("quality") == 0, quote(F.col("toxic"))).otherwise((F.col("toxic") == 1).cast("string"))
    parsed = docs(t.labels, obj(toxic=toxic), "doc_id")
    return parsed.select("doc_id", as_text(bool_token(field(F.col("doc"), "toxic"))).alias("toxic"))


@query(
    "r07_empty_for_null",
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '' WHEN 'O' THEN 'O' END AS status,
           o_orderstatus = 'P' AS absent
    FROM orders
    """,
)
def null_to_empty(t: Tables) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", NULL).when(F.col("o_orderstatus") == "O", '"O"')
    parsed = docs(t.orders, obj(status=status), "o_orderkey")
    value = empty_for_null(field(F.col("doc"), "status"))
    return parsed.select("o_orderkey", as_text(value).alias("status"), value.isNull().alias("absent"))


@query(
    "r08_text_list",
    """
    SELECT p_partkey, p_type || '|' || p_size || '|' || CASE WHEN p_size > 25 THEN 'yes' ELSE 'no' END AS languages
    FROM part
    """,
)
def string_list(t: Tables) -> DataFrame:
    items = arr(quote(F.col("p_type")), F.col("p_size"), (F.col("p_size") > 25).cast("string"))
    parsed = docs(t.part, obj(languages=items), "p_partkey")
    listed = F.transform(as_elements(text_list(field(F.col("doc"), "languages"))), as_text)
    return parsed.select("p_partkey", F.array_join(listed, "|").alias("languages"))


@query(
    "r09_struct_list_fields",
    """
    SELECT o_orderkey, 1 AS position, true AS is_object, CAST(o_custkey AS VARCHAR) AS id,
           CASE o_orderstatus WHEN 'F' THEN 'no' WHEN 'O' THEN 'yes' ELSE '' END AS status,
           CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS role
    FROM orders
    UNION ALL
    SELECT o_orderkey, 2, false, NULL, NULL, NULL FROM orders
    """,
)
def struct_list_fields(t: Tables) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "false").when(F.col("o_orderstatus") == "O", "true").otherwise("null")
    member = obj(
        id=quote(F.col("o_custkey")),
        status=status,
        role=F.when(F.col("o_orderpriority") != "5-LOW", quote(F.col("o_orderpriority"))),
    )
    parsed = docs(t.orders, obj(includes=arr(member, F.lit('"bare"'))), "o_orderkey")
    normal = struct_list(["id", "status", "role"])(field(F.col("doc"), "includes"))
    rows = parsed.select("o_orderkey", F.posexplode(as_elements(normal)).alias("position", "e"))
    e = F.col("e")
    return rows.select(
        "o_orderkey",
        (F.col("position") + 1).alias("position"),
        is_object(e).alias("is_object"),
        *[as_text(field(e, name)).alias(name) for name in ("id", "status", "role")],
    )


@query(
    "r09n_null_list",
    """
    SELECT c_custkey,
           CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN 0 ELSE 1 END AS n_names,
           CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN NULL ELSE 'no' END AS lang
    FROM customer
    """,
)
def null_list(t: Tables) -> DataFrame:
    segment = F.col("c_mktsegment")
    names = F.when(segment == "MACHINERY", NULL).when(
        segment != "BUILDING", arr(obj(lang=F.lit("false"), name=quote(F.col("c_name"))))
    )
    parsed = docs(t.customer, obj(other_names=names), "c_custkey")
    rule = struct_list(["lang", "name"], null_is_empty=True)
    listed = as_elements(rule(field(F.col("doc"), "other_names")))
    return parsed.select(
        "c_custkey",
        F.when(listed.isNotNull(), F.size(listed)).alias("n_names"),
        as_text(field(F.get(listed, F.lit(0)), "lang")).alias("lang"),
    )


@query(
    "r10_struct_list_filter",
    """
    SELECT conv_id, turn, 1 AS n_kept, CASE WHEN role = 'user' THEN 'no' ELSE role END AS lang,
           role = 'user' AS name_is_null
    FROM conversations
    """,
)
def struct_list_filter(t: Tables) -> DataFrame:
    user = F.col("role") == "user"
    entry = obj(
        lang=F.when(user, "false").otherwise(quote(F.col("role"))),
        name=F.when(user, NULL).otherwise(quote(F.col("text"))),
    )
    parsed = docs(t.conversations, obj(translations=arr(F.lit('"bare"'), entry, F.lit("7"))), "conv_id", "turn")
    rule = struct_list(["lang", "name"], bool_token, objects_only=True)
    kept = as_elements(rule(field(F.col("doc"), "translations")))
    first = F.get(kept, F.lit(0))
    return parsed.select(
        "conv_id",
        "turn",
        F.size(kept).alias("n_kept"),
        as_text(field(first, "lang")).alias("lang"),
        is_null(field(first, "name")).alias("name_is_null"),
    )


@query(
    "r11_nested_struct",
    """
    SELECT c_custkey, CASE WHEN c_acctbal < 5000 THEN '' ELSE c_name END AS city,
           CASE c_mktsegment WHEN 'BUILDING' THEN 'no' WHEN 'MACHINERY' THEN 'yes'
                ELSE 'N' || c_nationkey END AS country
    FROM customer
    """,
)
def nested_struct(t: Tables) -> DataFrame:
    segment = F.col("c_mktsegment")
    country = (
        F.when(segment == "BUILDING", "false")
        .when(segment == "MACHINERY", "true")
        .otherwise(quote(F.concat(F.lit("N"), F.col("c_nationkey"))))
    )
    city = F.when(F.col("c_acctbal") < 5000, NULL).otherwise(quote(F.col("c_name")))
    parsed = docs(t.customer, obj(headquarters=obj(city=city, country=country)), "c_custkey")
    seat = edit_fields(field(F.col("doc"), "headquarters"), {"city": text_field, "country": text_field})
    return parsed.select(
        "c_custkey", as_text(field(seat, "city")).alias("city"), as_text(field(seat, "country")).alias("country")
    )


@query(
    "r12_coordinate_default",
    """
    WITH t AS (
      SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN NULL
                             ELSE CAST(c_nationkey AS DOUBLE) END AS lat, c_mktsegment = 'HOUSEHOLD' AS no_object
      FROM customer)
    SELECT c_custkey, CASE WHEN no_object THEN NULL ELSE coalesce(lat, 0.0) END AS lat_zero,
           CASE WHEN no_object THEN NULL ELSE lat END AS lat_null
    FROM t
    """,
)
def coordinate_default(t: Tables) -> DataFrame:
    segment = F.col("c_mktsegment")
    lat = F.when(segment == "BUILDING", "null").when(segment == "MACHINERY", "true").otherwise(
        F.col("c_nationkey").cast("string")
    )
    place = F.when(segment == "HOUSEHOLD", NULL).otherwise(obj(lat=lat, lng=F.lit("3.5")))
    parsed = docs(t.customer, obj(coordinates=place), "c_custkey")

    def lat_of(mode: str) -> Column:
        number = missing_number(mode)
        fixed = edit_fields(field(F.col("doc"), "coordinates"), {"lat": number, "lng": number})
        return F.try_variant_get(field(fixed, "lat"), "$", "double").alias(f"lat_{mode}")

    return parsed.select("c_custkey", lat_of("zero"), lat_of("null"))


@query(
    "r13_polymorphic_list",
    """
    SELECT p_partkey,
           CASE p_type WHEN 'ECONOMY' THEN '' WHEN 'MEDIUM' THEN NULL WHEN 'LARGE' THEN p_brand || '|' || p_name
                       WHEN 'STANDARD' THEN CAST(p_size AS VARCHAR) ELSE p_brand END AS partof,
           CASE p_type WHEN 'ECONOMY' THEN '' WHEN 'MEDIUM' THEN NULL WHEN 'LARGE' THEN p_brand || '|' || p_name
                       WHEN 'SMALL' THEN 'id|name' WHEN 'STANDARD' THEN '{"id":' || p_size || '}'
                       ELSE p_brand END AS partof_compat
    FROM part
    """,
)
def polymorphic_list(t: Tables) -> DataFrame:
    kind, brand, name = F.col("p_type"), quote(F.col("p_brand")), quote(F.col("p_name"))
    shape = (
        F.when(kind == "ECONOMY", NULL)
        .when(kind == "PROMO", brand)
        .when(kind == "SMALL", obj(id=brand, name=name))
        .when(kind == "LARGE", arr(brand, name))
        .when(kind == "STANDARD", arr(obj(id=F.col("p_size"))))
    )
    parsed = docs(t.part, obj(partof=shape), "p_partkey")
    value = field(F.col("doc"), "partof")

    def listed(compat: bool) -> Column:
        return F.array_join(F.transform(as_elements(text_array(compat)(value)), as_text), "|")

    return parsed.select("p_partkey", listed(False).alias("partof"), listed(True).alias("partof_compat"))


def block_text() -> Column:
    """A block document per part, with something for every rule of the rule set."""
    size, kind = F.col("p_size"), F.col("p_type")
    return obj(
        id=quote(F.concat(F.lit("B"), F.col("p_partkey"))),
        name=F.when(kind == "SMALL", "false").otherwise(quote(F.col("p_name"))),
        status=F.when(size > 25, quote(F.lit("formal"))).otherwise("null"),
        languages=arr(F.lit('"en"'), (size > 25).cast("string"), F.col("p_size")),
        partof=F.when(kind == "PROMO", obj(id=quote(F.col("p_brand")), name=quote(F.col("p_name")))).when(
            kind == "LARGE", quote(F.col("p_brand"))
        ),
        includes=arr(
            obj(id=F.lit("false"), name=quote(F.col("p_name")), type=F.lit('"country"'), left=F.lit('"1990"')),
            obj(id=quote(F.col("p_brand")), name=F.lit("null"), type=F.lit('"organization"')),
        ),
        headquarters=obj(
            city=F.lit("null"), country=F.lit("false"), coordinates=obj(lat=F.lit("null"), lng=F.lit("true"))
        ),
        membership_count=F.col("p_size"),
        notes=quote(F.col("p_type")),
    )


@query(
    "r15_rule_dispatch",
    """
    SELECT 'B' || p_partkey AS id, CASE WHEN p_type = 'SMALL' THEN 'no' ELSE p_name END AS name,
           CASE WHEN p_size > 25 THEN 'formal' ELSE '' END AS status,
           'en|' || CASE WHEN p_size > 25 THEN 'yes' ELSE 'no' END || '|' || p_size AS languages,
           CASE WHEN p_type IN ('PROMO', 'LARGE') THEN p_brand END AS partof,
           'no|' || p_brand AS member_ids, 'no' AS country, CAST(0 AS DOUBLE) AS lat,
           CAST(0 AS DOUBLE) AS lng, p_type AS notes
    FROM part
    """,
)
def rule_dispatch(t: Tables) -> DataFrame:
    normal = normalise(docs(t.part, block_text()), "doc", rules_for("intblocks"))
    doc = F.col("doc")

    def joined(name: str, *inner: str) -> Column:
        items = F.transform(as_elements(field(doc, name)), lambda e: as_text(field(e, *inner) if inner else e))
        return F.array_join(items, "|")

    def coordinate(name: str) -> Column:
        return F.try_variant_get(field(doc, "headquarters", "coordinates", name), "$", "double").alias(name)

    return normal.select(
        as_text(field(doc, "id")).alias("id"),
        as_text(field(doc, "name")).alias("name"),
        as_text(field(doc, "status")).alias("status"),
        joined("languages").alias("languages"),
        joined("partof").alias("partof"),
        joined("includes", "id").alias("member_ids"),
        as_text(field(doc, "headquarters", "country")).alias("country"),
        coordinate("lat"),
        coordinate("lng"),
        as_text(field(doc, "notes")).alias("notes"),
    )


def order_schema() -> T.StructType:
    return T.StructType.fromDDL(
        "key bigint, status string, urgent boolean, customer struct<key:bigint,note:string>,"
        " items array<struct<k:bigint,s:string>>, absent string"
    )


def order_text(key: Column | None = None, urgent: Column | None = None) -> Column:
    item = obj(k=F.col("o_custkey"), s=quote(F.col("o_orderpriority")), left=F.lit('"1990"'))
    return obj(
        key=F.col("o_orderkey") if key is None else key,
        status=quote(F.col("o_orderstatus")),
        urgent=(F.col("o_orderpriority") == "1-URGENT").cast("string") if urgent is None else urgent,
        customer=obj(key=F.col("o_custkey"), extra=F.lit("{}")),
        items=arr(item, obj(k=F.lit("null"), s=F.lit('"x"'))),
        unknown=F.lit("[1]"),
    )


def flat_order(df: DataFrame) -> DataFrame:
    return df.select(
        "key",
        "status",
        "urgent",
        F.col("customer.key").alias("customer_key"),
        F.col("customer.note").alias("customer_note"),
        F.array_join(F.transform("items", lambda e: F.coalesce(e["k"].cast("string"), F.lit("-"))), "|").alias("item_keys"),
        F.array_join(F.transform("items", lambda e: e["s"]), "|").alias("item_texts"),
        "absent",
    )


@query(
    "r16_conform",
    """
    SELECT o_orderkey AS key, o_orderstatus AS status, o_orderpriority = '1-URGENT' AS urgent,
           o_custkey AS customer_key, CAST(NULL AS VARCHAR) AS customer_note, o_custkey || '|-' AS item_keys,
           o_orderpriority || '|x' AS item_texts, CAST(NULL AS VARCHAR) AS absent
    FROM orders
    """,
)
def conform_documents(t: Tables) -> DataFrame:
    return flat_order(conform(docs(t.orders, order_text()), "doc", order_schema()))


@query(
    "r17_conform_strict",
    """
    SELECT o_orderkey AS key, o_orderstatus AS status, o_orderpriority = '1-URGENT' AS urgent,
           o_custkey AS customer_key, CAST(NULL AS VARCHAR) AS customer_note, o_custkey || '|-' AS item_keys,
           o_orderpriority || '|x' AS item_texts, CAST(NULL AS VARCHAR) AS absent
    FROM orders
    """,
)
def conform_strict(t: Tables) -> DataFrame:
    return flat_order(conform(docs(t.orders, order_text()), "doc", order_schema(), mode="strict"))


@query(
    "r18_conform_violations",
    """
    SELECT o_orderkey, 'key' AS path, CAST(NULL AS INTEGER) AS position, 'long' AS expected, 'string' AS found,
           CAST(o_orderkey AS VARCHAR) AS value, 'type' AS issue
    FROM orders WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT o_orderkey, 'key', NULL, 'long', 'decimal', o_orderkey || '.5', 'lossy'
    FROM orders WHERE o_orderstatus = 'O'
    UNION ALL
    SELECT o_orderkey, 'urgent', NULL, 'boolean', 'bigint', '1', 'type'
    FROM orders WHERE o_orderpriority = '1-URGENT'
    """,
)
def conform_violations(t: Tables) -> DataFrame:
    key = (
        F.when(F.col("o_orderstatus") == "F", quote(F.col("o_orderkey")))
        .when(F.col("o_orderstatus") == "O", F.concat(F.col("o_orderkey"), F.lit(".5")))
        .otherwise(F.col("o_orderkey").cast("string"))
    )
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", "1").otherwise("false")
    parsed = docs(t.orders, order_text(key, urgent), "o_orderkey")
    return violations(parsed, "doc", order_schema(), keep=["o_orderkey"])


@query(
    "r19_schema_inference",
    """
    WITH pairs AS (
      SELECT DISTINCT unnest(json_keys(props)) AS k, json_type(json_extract(props, '$.k')) AS ty FROM events)
    SELECT 'OBJECT<' || string_agg(k || ': ' || CASE WHEN ty IN ('UBIGINT', 'BIGINT') THEN 'BIGINT' ELSE ty END, ', ')
           || '>' AS observed_schema
    FROM pairs
    """,
)
def schema_inference(t: Tables) -> DataFrame:
    return infer_schema(docs(t.events, F.col("props"), "event_id"), "doc")


@query(
    "s12_drift_report",
    """
    SELECT 'unknown' AS path, 'ARRAY' AS type, count(*) AS n FROM orders
    UNION ALL SELECT 'unknown[]', 'BIGINT', count(*) FROM orders
    UNION ALL SELECT 'customer.extra', 'OBJECT', count(*) FROM orders
    UNION ALL SELECT 'items[].left', 'STRING', count(*) FROM orders
    """,
)
def drift_report(t: Tables) -> DataFrame:
    return drift(docs(t.orders, order_text()), "doc", order_schema())
