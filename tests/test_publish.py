from __future__ import annotations

import gzip
import json

import pytest
from pyspark.sql import functions as F

from cartulary.operators.findings import totals
from cartulary.plans import queries_publishing
from cartulary.plans.build import build, build_dataset
from cartulary.plans.registry import Tables
from cartulary.schemas import block_schema
from cartulary.session import scratch_path, shared_folder
from cartulary.sinks.publish import merge_published, parse_formats, publish, publish_members, published_counts, write_json_lines, write_parquet, write_table
from cartulary.streaming.ingest import ingest, stream_json_lines

pytest.importorskip("yaml")


def test_formats_are_checked():
    assert parse_formats(" JSONL, parquet") == ["jsonl", "parquet"]
    with pytest.raises(ValueError, match="csv"):
        parse_formats("csv,parquet")


def test_json_lines_keep_the_raw_document(documents, tmp_path):
    out = str(tmp_path / "out")
    write_json_lines(documents('{"id":"é","left":null}').coalesce(1), out, "doc")
    (part,) = (tmp_path / "out").glob("part-*.gz")
    assert gzip.open(part, "rt", encoding="utf-8").read() == '{"id":"é","left":null}\n'


def test_parquet_is_nested_and_overwritten(spark, tmp_path):
    df = spark.range(3).select("id", F.array(F.struct(F.col("id").alias("x"))).alias("l"))
    for _ in range(2):
        write_parquet(df, str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 3 and back.schema["l"].dataType.elementType.names == ["x"]
    assert list((tmp_path / "t").glob("*.zstd.parquet"))


def test_table_is_recreated(spark, tmp_path):
    for n in (2, 5):
        write_table(spark.range(n), "cartulary_recreated", str(tmp_path / f"t{n}"))
    assert spark.table("cartulary_recreated").count() == 5


def test_publish_counts(spark, tmp_path):
    tables = {"a": spark.range(4), "b": spark.range(2)}
    publish(tables, str(tmp_path), "jsonl,parquet,table")
    rows = published_counts(spark, ["a", "b"], str(tmp_path), ["jsonl", "parquet", "table"]).collect()
    assert {(r.table_name, r.format, r.n_rows) for r in rows} == {
        (t, f, n) for t, n in (("a", 4), ("b", 2)) for f in ("jsonl", "parquet", "table")
    }


def test_build_from_yaml(spark, tmp_path):
    for folder, name, text in [
        ("countries", "NO", "code: 'NO'\nname: Norway\ncapital_city: {name: Oslo, lat: 59.9, lng: 10.7}\nborders: [SWE]\n"),
        ("blocks/energy", "X", "id: X\nname: NO\nincludes:\n- {id: NO, name: Norway, left: '1999'}\npartof: {id: Y}\nnotes: n\n"),
        ("blocks/bank", "Y", "id: [unclosed\n"),
    ]:
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / folder / f"{name}.yaml").write_text(text)
    (tmp_path / "blocktypes.yaml").write_text("- id: energy\n  name: Energy\n  other_names:\n- id: bank\n  name: Bank\n")
    counts = build(
        spark,
        str(tmp_path / "countries"),
        str(tmp_path / "blocks"),
        str(tmp_path / "blocktypes.yaml"),
        str(tmp_path / "out"),
        "jsonl,parquet",
    )
    rows = {r.table_name: tuple(r)[1:] for r in counts.collect()}
    assert rows == {"countries": (1, 1, 0, 0, 1, 0), "intblocks": (2, 1, 0, 1, 1, 0), "blocktypes": (2, 2, 0, 0, 2, 0)}
    (bad,) = spark.read.parquet(str(tmp_path / "out/intblocks.quarantine")).collect()
    assert bad.path.endswith("Y.yaml") and bad.error.startswith("YAML error")
    block = spark.read.parquet(str(tmp_path / "out/intblocks.parquet")).first()
    assert (block.name, block.partof, block.includes[0].id) == ("no", ["Y"], "no")
    raw = json.loads(spark.read.text(str(tmp_path / "out/intblocks.jsonl")).first()[0])
    assert raw["notes"] == "n" and raw["includes"][0]["left"] == "1999"
    types = spark.read.parquet(str(tmp_path / "out/blocktypes.parquet")).collect()
    assert {(t.id, None if t.other_names is None else len(t.other_names)) for t in types} == {("energy", 0), ("bank", None)}


def test_build_accounts_for_odd_input(spark, tmp_path):
    """Every file is in one class, a mismatch in the violations, and a file that holds no list is not lost."""
    for folder, name, text in [
        ("countries", "A", b"code: A\nborders:\nname: [x]\n"), ("countries", "B", b""), ("countries", "C", b"# comment\n"), ("countries", "D", b"code: \xff\n"),
        ("countries", "E", b"code: E\narea: .nan\n"), ("countries", "F", b"1: x\n'1': y\n"), ("blocks", "X", b"id: X\nmembership_count: many\n"),
    ]:
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / folder / f"{name}.yaml").write_bytes(text)
    (tmp_path / "types.yaml").write_text("id: energy\n")
    out = tmp_path / "out"
    counts = build(spark, *[str(tmp_path / p) for p in ("countries", "blocks", "types.yaml")], str(out), "parquet", level=22)
    rows = {r.table_name: r for r in counts.collect()}
    assert tuple(rows["countries"])[1:6] == (6, 1, 2, 3, 1)
    assert tuple(rows["blocktypes"])[1:6] == (1, 0, 0, 1, 0)
    assert (rows["intblocks"].n_published, rows["intblocks"].n_violations) == (1, 1)
    for r in rows.values():
        assert r.n_documents == r.n_good + r.n_empty + r.n_quarantined and r.n_published == r.n_good
    bad = {r.path[-6]: r.error for r in spark.read.parquet(f"{out}/countries.quarantine").collect()}
    assert set(bad) == {"D", "E", "F"} and bad["D"] == "not UTF-8 text" and bad["E"] == bad["F"]
    assert spark.read.parquet(f"{out}/blocktypes.quarantine").first().error == "not a list of documents: object"
    places = {(r.path, r.found) for r in spark.read.parquet(f"{out}/countries.violations").collect()}
    assert places == {("borders", "void"), ("name", "array")}


def test_a_data_set_is_parsed_once(spark, documents, tmp_path, monkeypatch):
    """All that is published comes from the one parse that was written."""
    from cartulary.plans import build as plan

    seen = []
    monkeypatch.setattr(plan, "publish", lambda tables, *a: seen.extend([*tables.values(), *(d for d, _ in a[3].values())]))
    monkeypatch.setattr(plan, "published_counts", lambda *a: spark.createDataFrame([("intblocks", 1, "parquet")], "table_name string, n_rows long, format string"))
    monkeypatch.setattr(plan, "write_parquet", lambda df, path: (seen.append(df), df.write.parquet(path)))
    plan.build_parsed(spark, {"intblocks": documents('{"id":"a"}', "{", "{}")}, str(tmp_path), "parquet")
    assert len(seen) == 4
    for df in seen:
        assert "parse_json" not in df._jdf.queryExecution().optimizedPlan().toString().lower().replace("parsejson", "parse_json")


def test_dataset_stages_add_up(documents):
    parsed = documents('{"id":"a","membership_count":"x"}', "{}", '{"id"', '{"id":"b"}')
    stages = build_dataset(parsed, "intblocks")
    assert (stages.typed.count(), stages.quarantine.count(), stages.documents.count()) == (2, 1, 2)
    (place,) = stages.violations.collect()
    assert place[1:4] == ("membership_count", None, "long")


def test_tables_of_one_layout_join_without_an_exchange(spark, tmp_path):
    """The bridge of blocks and members against members' names, both published by member."""
    pairs = spark.range(3000).selectExpr("id % 50 AS block", "id % 700 AS member")
    names = spark.range(700).selectExpr("id AS member", "concat('m', id) AS name")
    write_table(pairs, "cartulary_bridge", str(tmp_path / "bridge"), 4, ["member"])
    write_table(names, "cartulary_names", str(tmp_path / "names"), 4, ["member"])
    joined = spark.table("cartulary_bridge").join(spark.table("cartulary_names").hint("merge"), "member")
    for df in (joined, joined.groupBy("member").count()):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 3000
    assert len(list((tmp_path / "bridge").glob("part-*"))) == 4


def test_merging_again_changes_no_file(spark, tmp_path):
    path = str(tmp_path / "members")
    old = spark.range(500).selectExpr("id % 40 AS block", "id AS member")
    publish_members(old, path, shares=16)

    def files():
        return {str(p): p.stat().st_mtime_ns for p in (tmp_path / "members").rglob("part-*")}

    before = files()
    more = spark.createDataFrame([(3, 3), (3, 9000), (3, 9000), (77, 1)], "block long, member long")
    assert merge_published(spark, path, more, shares=16) == 2
    after = files()
    touched = {p.split("share=")[1].split("/")[0] for p in before.keys() ^ after.keys()}
    assert 1 <= len(touched) <= 2
    rows = sorted(map(tuple, spark.read.parquet(path).select("block", "member").collect()))
    assert rows == sorted([*map(tuple, old.collect()), (3, 9000), (77, 1)])
    assert merge_published(spark, path, more, shares=16) == 0 and files() == after


def test_stream_of_documents(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    (source / "1.jsonl").write_text('{"id":"a","name":false}\n{"id"\n{}\n')
    for _ in range(2):
        parsed = stream_json_lines(spark, str(source), files_per_trigger=1)
        query = ingest(parsed, block_schema(), str(out), str(tmp_path / "cp"))
        query.awaitTermination()
        (source / "2.jsonl").write_text('{"id":"b"}\n')
    good = spark.read.parquet(str(out / "good"))
    assert {r.id for r in good.collect()} == {"a", "b"}
    assert spark.read.parquet(str(out / "quarantine")).count() == 1


def test_scratch_is_under_the_configured_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared_folder(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_totals_of_nothing(spark):
    empty = spark.createDataFrame([], "n_findings bigint")
    assert tuple(totals(empty, F.col("n_findings")).first()) == (0, 0, 0)


def test_buckets_grow_with_the_tables(spark, monkeypatch):
    """60 buckets for 6,000 lines at 100 a bucket, and no rows moved for the join."""
    monkeypatch.setattr(queries_publishing, "BUCKET_ROWS", 100)
    found = queries_publishing.bucketed_join(Tables(spark, "/root/testdata/sf0.001"))
    n_lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    assert found.agg(F.sum("n_lines")).first()[0] == n_lines
    asked = -(-n_lines // 100)
    for table in ("cartulary_by_order_orders", "cartulary_by_order_lineitem"):
        layout = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
        assert layout["Num Buckets"] == str(asked)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "hashpartitioning(l_orderkey" not in text and "hashpartitioning(o_orderkey" not in text
