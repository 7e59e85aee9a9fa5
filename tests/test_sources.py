from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from cartulary.functions.variants import is_falsy
from cartulary.plans.validate import validate
from cartulary.sources import files
from cartulary.sources.documents import (
    account,
    drop_empty,
    good_documents,
    list_documents,
    list_items,
    not_lists,
    parse_documents,
    quarantined,
    read_json_lines,
    scan_documents,
    source_census,
    yaml_parser,
)
from cartulary.sources.files import read_files
from cartulary.sources.legacy import legacy_documents, read_legacy

yaml = pytest.importorskip("yaml")


@pytest.fixture
def folder(tmp_path):
    for category, name, text in [
        ("bank", "A", "id: A\nname: NO\nheadquarters:\n  country: NO\nlanguages: [en, no]\nfounded: 1999-01-02\n"),
        ("bank", "B", "id: B\nname: [unclosed\n"),
        ("trade", "C", "# nothing but a comment\n"),
        ("trade", "D", "id: D\nname: Déjà\n"),
    ]:
        (tmp_path / category).mkdir(exist_ok=True)
        (tmp_path / category / f"{name}.yaml").write_text(text, encoding="utf-8")
    (tmp_path / "trade" / "notes.txt").write_text("not a document")
    return tmp_path


def test_yaml_documents(spark, folder):
    parsed = scan_documents(spark, str(folder), "*.yaml", yaml_parser)
    assert parsed.count() == 4
    bad = quarantined(parsed).collect()
    assert len(bad) == 1 and bad[0].path.endswith("bank/B.yaml") and bad[0].error.startswith("YAML error: ")
    findings = validate(parsed).findings.filter("rule in ('parse_error', 'empty_document')").orderBy("path").collect()
    assert [f.path.rsplit("/", 1)[1] for f in findings] == ["B.yaml", "C.yaml"]
    assert findings[0].message == bad[0].error
    kept = drop_empty(good_documents(parsed)).select(F.to_json("doc")).collect()
    docs = sorted((json.loads(r[0]) for r in kept), key=lambda d: d["id"])
    assert docs == [
        {"id": "A", "name": False, "headquarters": {"country": False}, "languages": ["en", False], "founded": "1999-01-02"},
        {"id": "D", "name": "Déjà"},
    ]


ODD = {"good": b"a: 1\n", "zero": b"", "blank": b" \n", "latin": b"a: \xe9\n", "nan": b"a: .nan\n", "keys": b"1: a\n'1': b\n", "open": b"a: [\n", "date": b"2020-01-01: x\n"}


@pytest.mark.parametrize("parser", [yaml_parser, None])
def test_every_file_is_in_one_class(spark, tmp_path, parser):
    for name, content in ODD.items():
        (tmp_path / f"{name}.yaml").write_bytes(content)
    (tmp_path / "_hidden.yaml").write_bytes(b"a: 1")
    parsed = scan_documents(spark, str(tmp_path), "*.yaml", parser)
    row = account(parsed).first()
    assert row.n_documents == len(ODD) == row.n_good + row.n_empty + row.n_quarantined
    bad = {r.path.rsplit("/", 1)[1][:-5] for r in quarantined(parsed).collect()}
    void = {r.path.rsplit("/", 1)[1][:-5] for r in good_documents(parsed).filter(is_falsy(F.col("doc"))).collect()}
    if parser is not None:
        assert (bad, void) == ({"latin", "nan", "keys", "open", "date"}, {"zero", "blank"})
    else:
        assert void == {"zero"} and "latin" in bad
    assert sum(r.n_documents for r in source_census(spark, str(tmp_path)).collect()) == len(ODD)
    found = validate(parsed).findings.filter("rule = 'empty_document'").collect()
    assert len(found) == len(void)


def test_files_are_packed_by_bytes(spark, tmp_path):
    for i in range(9):
        (tmp_path / f"{i}.bin").write_bytes(b"x" * 1000)
    few = read_files(spark, str(tmp_path))
    many = read_files(spark, str(tmp_path), partitionBytes=str(3 * (files.OPEN_COST + 1000)), cellBytes="2000")
    assert few.rdd.getNumPartitions() == 1 and many.rdd.getNumPartitions() == 3
    assert many.agg(F.sum(F.length("content")), F.sum("size"), F.count("problem")).first() == (9000, 9000, 0)
    (tmp_path / "long.bin").write_bytes(b"x" * 3000)
    assert [r.problem for r in read_files(spark, str(tmp_path), "long*", cellBytes="2000").collect()] == [files.TOO_LONG]
    assert read_files(spark, str(tmp_path), "none*").count() == 0
    assert sorted(map(tuple, files.spark_files(spark, str(tmp_path)).select("size", "problem").collect()))[-1] == (3000, None)


def test_spark_reader_accounts_for_files_of_length_zero(spark, tmp_path):
    for name, content in ODD.items():
        (tmp_path / f"{name}.yaml").write_bytes(content)
    read = {r.path.rsplit("/", 1)[1][:-5]: bytes(r.content) for r in files.spark_files(spark, str(tmp_path)).collect()}
    assert read == ODD


def test_an_unreadable_file_is_one_row(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id":1}')
    store = files.FileReader({"path": str(tmp_path)})
    (batch,) = store.read(files.Files([(str(tmp_path / "gone.json"), 5), (str(tmp_path / "a.json"), 8)]))
    assert batch.column("problem").to_pylist()[0].startswith("cannot be read") and batch.column("content").to_pylist()[1] == b'{"id":1}'


def test_lists_account_for_every_file(documents):
    parsed = list_documents(documents('[{"id":1},{"id":2},null]', "null", '{"id":"x"}', "[]", "[1"))
    rows = sorted((r.path[-6], r.position, r.error) for r in parsed.collect())
    assert rows == [("0", 1, None), ("0", 2, None), ("0", 3, None), ("1", None, None), ("2", None, "not a list of documents: object"), ("3", None, None), ("4", None, "malformed document")]
    assert tuple(account(parsed).first()) == (7, 2, 3, 2)


def test_good_and_quarantined_add_up(documents):
    parsed = documents('{"a":1}', '{"a":', "null", "", "[1,2")
    assert good_documents(parsed).count() + quarantined(parsed).count() == parsed.count() == 5
    assert quarantined(parsed).count() == 3


def test_empty_documents(documents):
    parsed = documents("{}", "null", "[]", '""', "0", "0.0", "false", '{"a":null}', "[0]", '"x"', "1", "true", '"false"', '"0"')
    kept = {r.text for r in drop_empty(parsed).collect()}
    assert kept == {'{"a":null}', "[0]", '"x"', "1", "true", '"false"', '"0"'}


def test_lists_of_documents(documents):
    parsed = documents('[{"id":1},{"id":2}]', "null", '{"id":"x"}', "[]")
    items = [(r.path, r.position) for r in list_items(parsed, keep=["path"]).collect()]
    assert items == [("/data/0.json", 1), ("/data/0.json", 2)]
    assert [(r.path, r.found) for r in not_lists(parsed, keep=["path"]).collect()] == [("/data/2.json", "object")]


def test_json_files_and_lines(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.json").write_text('{\n "id": "é"\n}', encoding="utf-8")
    (tmp_path / "b.json").write_text("{broken")
    parsed = scan_documents(spark, str(tmp_path))
    assert sorted((r.error is None) for r in parsed.collect()) == [False, True]
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "p.jsonl").write_text('{"id":1}\n{"id":\n', encoding="utf-8")
    rows = read_json_lines(spark, str(lines)).collect()
    assert [r.error for r in rows] == [None, "malformed document"] and rows[0].path.endswith("p.jsonl")


def test_census_reads_no_content(spark, folder):
    census = source_census(spark, str(folder))
    assert {r.category: r.n_documents for r in census.collect()} == {"bank": 2, "trade": 2}
    (tmp,) = read_files(spark, str(folder / "bank"), "A*", content=False).collect()
    assert tmp.content is None and tmp.size > 0


def test_legacy_records(spark, tmp_path):
    records = [{"id": "r1", "createdTime": "t", "fields": {"key": "K", "country": ["c"], "unknown": 1}}, {"id": "r2"}]
    (tmp_path / "legacy.json").write_text(json.dumps(records, indent=1))
    rows = read_legacy(spark, str(tmp_path / "legacy.json")).collect()
    assert [(r.id, r.key, r.country) for r in rows] == [("r1", "K", ["c"]), ("r2", None, None)]


def test_legacy_files_are_accounted_for(spark, tmp_path):
    for name, text in {"a": '[{"id":"r1","fields":{"key":"K"}},7,{"id":2}]', "b": '[{"id":', "c": '{"id":"x"}', "d": "[]", "e": ""}.items():
        (tmp_path / f"{name}.json").write_text(text)
    records, odd = legacy_documents(scan_documents(spark, str(tmp_path)))
    assert sorted((r.id, r.key) for r in records.collect() if r.id) == [("r1", "K")] and records.count() == 2
    assert sorted((r.path[-6], r.position, r.error) for r in odd.collect()) == [("a", 2, "not a record"), ("b", None, "malformed document"), ("c", None, "not a list of documents: object")]
    assert read_legacy(spark, str(tmp_path / "b.json")).count() == 0


def test_null_text_is_no_error(spark):
    df = spark.createDataFrame([(None,)], "text string")
    assert parse_documents(df, "text").first().error is None
