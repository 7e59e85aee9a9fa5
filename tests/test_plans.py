"""Shapes of physical plans that matter at scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from cartulary.operators.conform import conform
from cartulary.plans import queries_publishing
from cartulary.plans.validate import validate
from cartulary.schemas import block_schema

SF_DIR = "/root/testdata/sf0.001"
SINKS = {"r23_json_lines_sink", "r24_parquet_sink", "r25_relational_publish", "r26_publish_plan", "r26_build_accounts", "r01_document_files", "r25_bucketed_join", "d14_published_merge"}
ROW_LOCAL = [
    "r01_document_scan", "r02_bad_document_isolation", "r03_empty_document_drop", "r04_list_document_scan",
    "r06_boolean_token", "r07_empty_for_null", "r08_text_list", "r09_struct_list_fields", "r09n_null_list",
    "r10_struct_list_filter", "r11_nested_struct", "r12_coordinate_default", "r13_polymorphic_list",
    "r15_rule_dispatch", "r16_conform", "r17_conform_strict", "r18_conform_violations",
    "s02_required_in_element", "s03_type", "s04_length", "s05_pattern", "s06_enum", "s07_min_items",
    "s08_minimum", "s09_nullable_type", "s10_one_of", "s11_uri", "v02_positioned_links", "v03_link_structure",
    "v04_entity_id_extraction", "v05_ids_per_entity", "v06_id_format", "v07_id_consistency", "v07b_id_missing",
    "v08_url_format", "v09_check_routing", "v14_unreadable_documents", "v15_findings", "v15_verdicts",
    "d05_declared_count", "d09_membership_bridge", "d10_members_at_date", "d16_field_migration", "d18_localised_name",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SINKS))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    for forbidden in ("Python", "ArrowEval", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert forbidden not in text


@pytest.mark.parametrize("name", ROW_LOCAL)
def test_row_local_operators_do_not_shuffle(spark, name):
    assert "Exchange" not in plan(entry.queries()[name](spark, SF_DIR))


def test_a_document_is_parsed_once(documents):
    parsed = documents('{"id":"a"}')
    for df in (validate(parsed).findings, validate(parsed).verdicts, parsed.filter("error is null")):
        assert plan(df).count("parseJson(") == 1


def test_links_are_taken_apart_once(documents):
    findings = validate(documents('{"id":"a"}')).findings.filter("rule = 'id_missing'")
    assert plan(findings).count("AS links") <= 1


def test_unread_columns_stay_on_disk(spark):
    text = plan(entry.queries()["d12_block_algebra"](spark, SF_DIR))
    schema = text.split("ReadSchema: ")[1].split("\n")[0]
    assert "l_orderkey" in schema and "l_returnflag" in schema and "l_quantity" not in schema
    assert "PushedFilters: [Or(EqualTo(l_returnflag,A),EqualTo(l_returnflag,R))" in text


def test_declared_fields_are_pruned(documents):
    typed = conform(documents('{"id":"a"}'), "doc", block_schema()).select("id")
    assert "headquarters" not in plan(typed).split("Project")[1].split("\n")[0]


def test_sides_are_broadcast_by_their_size(spark):
    """No plan broadcasts on a hint; beside a small dimension facts stay where they are, large sides are sorted and split."""
    text = plan(entry.queries()["d02_code_crosswalk"](spark, SF_DIR))
    assert "BroadcastHashJoin" in text
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:
        spark.conf.set(name, "-1")
    try:
        for query in ("v11_entity_lookup", "d02_code_crosswalk", "d07_enrichment_join", "d17_duplicate_identities", "d15_group_generation"):
            text = plan(entry.queries()[query](spark, SF_DIR))
            assert "SortMergeJoin" in text and "Broadcast" not in text
            assert "Limit" not in text
    finally:
        for name in names:
            spark.conf.unset(name)


@pytest.mark.parametrize(("name", "table"), [("v11_entity_lookup", "lineitem"), ("d17_duplicate_identities", "part"), ("v10_probe_outcomes", "orders")])
def test_no_table_is_counted_before_its_join(spark, name, table):
    scans = plan(entry.queries()[name](spark, SF_DIR)).count(f"{table}.parquet")
    assert scans <= {"v11_entity_lookup": 1, "d17_duplicate_identities": 2, "v10_probe_outcomes": 1}[name]


def test_duplicates_need_no_window(spark):
    for name in ("d17_duplicate_identities", "d17_keep_one"):
        assert "Window" not in plan(entry.queries()[name](spark, SF_DIR))


def test_counts_combine_before_the_shuffle(spark):
    for name in ("d04_array_facets", "v17_finding_histogram", "r05_source_census"):
        text = plan(entry.queries()[name](spark, SF_DIR))
        assert "partial_count" in text


def test_report_takes_the_top_rows_per_task(spark):
    assert "TakeOrderedAndProject(limit=100" in plan(entry.queries()["v19_first_findings"](spark, SF_DIR))




def test_documents_of_a_small_file_are_dealt_over_all_cores(spark, monkeypatch):
    """A file of one row group is one task; what is made from its rows must not be."""
    seen = []
    monkeypatch.setattr(queries_publishing, "publish", lambda tables, output, documents: seen.extend([tables["blocks"], documents["blocks"][0]]))
    monkeypatch.setattr(queries_publishing, "published_counts", lambda *args: None)
    monkeypatch.setattr(queries_publishing, "build_parsed", lambda spark, parsed, *args: seen.extend(parsed.values()))
    for query in ("r26_publish_plan", "r26_build_accounts"):
        entry.queries()[query](spark, SF_DIR)
    assert len(seen) == 4
    assert all(df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism for df in seen)
