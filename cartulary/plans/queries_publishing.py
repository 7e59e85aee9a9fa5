"""Queries for the sinks: write under the shared folder, read back."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.functions.variants import as_text, field, is_falsy
from cartulary.operators.conform import conform
from cartulary.operators.normalize import normalise, rules_for
from cartulary.plans.build import build_parsed
from cartulary.plans.queries_documents import block_text, docs
from cartulary.plans.registry import Tables, arr, obj, query, quote
from cartulary.schemas import block_schema
from cartulary.session import scratch_path, spread
from cartulary.sinks.publish import (
    merge_published,
    publish,
    publish_members,
    published_counts,
    row_counts,
    write_json_lines,
    write_parquet,
    write_table,
)
from cartulary.sources.documents import read_json_lines, scan_documents

COUNTS_SQL = """
    SELECT 'customer' AS table_name, count(*) AS n_rows FROM customer
    UNION ALL SELECT 'part', count(*) FROM part
    UNION ALL SELECT 'nation', count(*) FROM nation
"""


def three_tables(t: Tables) -> dict[str, DataFrame]:
    return {"customer": t.customer, "part": t.part, "nation": t.nation}


@query("r21_row_counts", COUNTS_SQL)
def table_row_counts(t: Tables) -> DataFrame:
    return row_counts(three_tables(t))


@query(
    "r23_json_lines_sink",
    """
    SELECT c_custkey AS id, c_name AS name, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS segment,
           'é ' || c_nationkey AS notes
    FROM customer
    """,
)
def json_lines_round_trip(t: Tables) -> DataFrame:
    text = obj(
        id=F.col("c_custkey"),
        name=quote(F.col("c_name")),
        segment=F.when(F.col("c_mktsegment") != "BUILDING", quote(F.col("c_mktsegment"))),
        notes=quote(F.concat(F.lit("é "), F.col("c_nationkey"))),
    )
    path = scratch_path(t.spark, "jsonl")
    write_json_lines(docs(spread(t.customer), text), path, "doc")
    doc = F.col("doc")
    return read_json_lines(t.spark, path).select(
        as_text(field(doc, "id")).cast("bigint").alias("id"),
        *[as_text(field(doc, name)).alias(name) for name in ("name", "segment", "notes")],
    )


@query(
    "r24_parquet_sink",
    """
    SELECT 'B' || p_partkey AS id, CASE WHEN p_type = 'SMALL' THEN 'no' ELSE p_name END AS name,
           'no|' || p_brand AS member_ids, CAST(p_size AS BIGINT) AS membership_count,
           CAST(0 AS DOUBLE) AS lat
    FROM part
    """,
)
def parquet_round_trip(t: Tables) -> DataFrame:
    typed = conform(docs(spread(t.part), block_text()), "doc", block_schema(), rules=rules_for("intblocks"))
    path = scratch_path(t.spark, "parquet")
    write_parquet(typed, path)
    return t.spark.read.parquet(path).select(
        "id",
        "name",
        F.array_join(F.transform("includes", lambda m: m["id"]), "|").alias("member_ids"),
        "membership_count",
        F.col("headquarters.coordinates.lat").alias("lat"),
    )


@query("r25_relational_publish", COUNTS_SQL)
def relational_publish(t: Tables) -> DataFrame:
    published = {}
    for name, df in three_tables(t).items():
        table = f"cartulary_{name}"
        write_table(df, table, scratch_path(t.spark, table))
        published[name] = t.spark.table(table)
    return row_counts(published)


@query(
    "r26_publish_plan",
    """
    SELECT table_name, format, n_rows
    FROM (SELECT 'blocks' AS table_name, count(*) AS n_rows FROM part
          UNION ALL SELECT 'customer', count(*) FROM customer),
         (VALUES ('jsonl'), ('parquet'), ('table')) AS f(format)
    """,
)
def publish_plan(t: Tables) -> DataFrame:
    parsed = docs(spread(t.part), block_text())
    rules = rules_for("intblocks")
    tables = {"blocks": conform(parsed, "doc", block_schema(), rules=rules), "customer": t.customer}
    output = scratch_path(t.spark, "build")
    publish(tables, output, documents={"blocks": (normalise(parsed, "doc", rules), "doc")})
    return published_counts(t.spark, list(tables), output, ["jsonl", "parquet", "table"])


# Customers as documents: every eleventh cut off, every seventh of the rest empty, names of some no text.
FATE = "CASE WHEN c_custkey % 11 = 0 THEN 'quarantined' WHEN c_custkey % 7 = 0 THEN 'empty' ELSE 'good' END"


def country_text() -> Column:
    key = F.col("c_custkey")
    whole = obj(
        code=quote(F.concat(F.lit("C"), key)),
        name=F.when(key % 5 == 0, F.lit("[1]")).otherwise(quote(F.col("c_name"))),
        borders=F.when(key % 3 == 0, F.lit("null")).otherwise(arr(quote(F.concat(F.lit("N"), F.col("c_nationkey"))))),
    )
    return F.when(key % 11 == 0, F.regexp_replace(whole, "}$", "")).when(key % 7 == 0, F.lit("{}")).otherwise(whole)


@query(
    "r26_build_accounts",
    f"""
    WITH c AS (SELECT c_custkey AS k, {FATE} AS fate FROM customer)
    SELECT 'countries' AS table_name, count(*) AS n_documents, count(*) FILTER (WHERE fate = 'good') AS n_good,
           count(*) FILTER (WHERE fate = 'empty') AS n_empty, count(*) FILTER (WHERE fate = 'quarantined') AS n_quarantined,
           count(*) FILTER (WHERE fate = 'good') AS n_published,
           count(*) FILTER (WHERE fate = 'good' AND k % 5 = 0) + count(*) FILTER (WHERE fate = 'good' AND k % 3 = 0) AS n_violations
    FROM c
    UNION ALL
    SELECT 'intblocks', count(*), count(*), 0, 0, count(*), 0 FROM part
    """,
)
def build_accounts(t: Tables) -> DataFrame:
    parsed = {
        "countries": docs(spread(t.customer).withColumn("path", F.col("c_custkey").cast("string")), country_text(), "path"),
        "intblocks": docs(spread(t.part).withColumn("path", F.col("p_partkey").cast("string")), block_text(), "path"),
    }
    return build_parsed(t.spark, parsed, scratch_path(t.spark, "build"), "parquet")


def write_files(df: DataFrame, folder: str, name: str, content: str) -> int:
    """A file for each row, written by the tasks to a shared folder; returns how many."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pyarrow.fs.FileSystem.from_uri(folder)
        store.create_dir(root)
        for batch in batches:
            for path, data in zip(batch.column(name).to_pylist(), batch.column(content).to_pylist(), strict=True):
                with store.open_output_stream(f"{root}/{path}") as out:
                    out.write(data)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    return df.select(name, content).mapInArrow(write, "n long").agg(F.sum("n")).first()[0]


@query(
    "r01_document_files",
    """
    SELECT s_suppkey AS k, CASE WHEN s_suppkey % 9 = 0 THEN 'empty' WHEN s_suppkey % 7 = 0 OR s_suppkey % 5 = 0 THEN 'quarantined' ELSE 'good' END AS fate,
           CASE WHEN s_suppkey % 9 <> 0 AND s_suppkey % 7 = 0 THEN 'not UTF-8 text' WHEN s_suppkey % 9 <> 0 AND s_suppkey % 5 = 0 THEN 'malformed document' END AS error,
           CASE WHEN s_suppkey % 9 <> 0 AND s_suppkey % 7 <> 0 AND s_suppkey % 5 <> 0 THEN s_name END AS name
    FROM supplier
    """,
)
def document_files(t: Tables) -> DataFrame:
    """A file for each supplier: some of length zero, some no UTF-8, some cut off."""
    key = F.col("s_suppkey")
    text = obj(name=quote(F.col("s_name")))
    content = (
        F.when(key % 9 == 0, F.lit(b""))
        .when(key % 7 == 0, F.concat(text.cast("binary"), F.lit(b"\xff")))
        .when(key % 5 == 0, F.regexp_replace(text, "}$", "").cast("binary"))
        .otherwise(text.cast("binary"))
    )
    folder = scratch_path(t.spark, "files")
    write_files(t.supplier.select(F.concat(key, F.lit(".json")).alias("name"), content.alias("content")), folder, "name", "content")
    parsed = scan_documents(t.spark, folder)
    fate = F.when(F.col("error").isNotNull(), "quarantined").when(is_falsy(F.col("doc")), "empty").otherwise("good")
    return parsed.select(
        F.regexp_extract("path", "([0-9]+)[.]json$", 1).cast("bigint").alias("k"), fate.alias("fate"), "error",
        F.when(fate == "good", as_text(field(F.col("doc"), "name"))).alias("name"),
    )


@query(
    "r25_bucketed_join",
    """
    SELECT o_orderpriority, count(*) AS n_lines, CAST(sum(l_quantity) AS BIGINT) AS quantity
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1
    """,
)
def bucketed_join(t: Tables) -> DataFrame:
    """Two published tables of one layout meet without moving a row."""
    orders, lines = published_buckets(t)
    joined = lines.join(orders.hint("merge"), lines.l_orderkey == orders.o_orderkey)
    return joined.groupBy("o_orderpriority").agg(F.count("*").alias("n_lines"), F.sum("l_quantity").cast("bigint").alias("quantity"))


BUCKET_ROWS = 1_000_000


def published_buckets(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Both tables in as many buckets as the larger one asks for: a bucket is sorted, written and joined by one task."""
    most = max(t.orders.count(), t.lineitem.count())
    buckets = max(8, -(-most // BUCKET_ROWS))
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        table = f"cartulary_by_order_{name}"
        write_table(getattr(t, name), table, scratch_path(t.spark, table), buckets, [key])
    return t.spark.table("cartulary_by_order_orders"), t.spark.table("cartulary_by_order_lineitem")


@query(
    "d14_published_merge",
    """
    SELECT s_nationkey AS block, s_suppkey AS member FROM supplier
    UNION SELECT c_nationkey, c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'
    """,
)
def published_merge(t: Tables) -> DataFrame:
    """Suppliers as members, published; customers merged in, twice; the table as read back."""
    path = scratch_path(t.spark, "members")
    publish_members(t.supplier.select(F.col("s_nationkey").alias("block"), F.col("s_suppkey").alias("member")), path)
    more = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select(F.col("c_nationkey").alias("block"), F.col("c_custkey").alias("member"))
    merge_published(t.spark, path, more)
    if merge_published(t.spark, path, more):
        raise AssertionError("a merge that is run again must find nothing to add")
    return t.spark.read.parquet(path).select("block", "member")
