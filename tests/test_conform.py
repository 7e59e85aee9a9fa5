from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartulary.operators.conform import conform, infer_schema, violations
from cartulary.operators import drift as drift_module
from cartulary.operators.drift import declared_paths, drift, observed_paths
from cartulary.schemas import block_schema, country_schema


@pytest.fixture
def schema(spark):
    return T.StructType.fromDDL(
        "s string, n bigint, d double, b boolean, o struct<s:string,p:struct<d:double>>,"
        " l array<string>, ol array<struct<id:string,n:bigint>>, m map<string,struct<x:string>>"
    )


CASES = [
    ('{"s":"x"}', ("s", "x"), []),
    ('{"s":1}', ("s", None), [("s", None, "string", "bigint", "1", "type")]),
    ('{"s":true}', ("s", None), [("s", None, "string", "boolean", "true", "type")]),
    ('{"s":null}', ("s", None), []),
    ('{"n":3}', ("n", 3), []),
    ('{"n":3.0}', ("n", 3), []),
    ('{"n":3.5}', ("n", 3), [("n", None, "long", "decimal", "3.5", "lossy")]),
    ('{"n":"3"}', ("n", None), [("n", None, "long", "string", "3", "type")]),
    ('{"d":1}', ("d", 1.0), []),
    ('{"d":"1.5"}', ("d", None), [("d", None, "double", "string", "1.5", "type")]),
    ('{"d":true}', ("d", None), [("d", None, "double", "boolean", "true", "type")]),
    ('{"b":"true"}', ("b", None), [("b", None, "boolean", "string", "true", "type")]),
    ('{"o":"x"}', ("o", None), [("o", None, "object", "string", "x", "type")]),
    ('{"o":{"s":"a","z":1}}', ("o", ("a", None)), []),
    ('{"o":{"p":{"d":false}}}', ("o", (None, (None,))), [("o.p.d", None, "double", "boolean", "false", "type")]),
    ('{"l":["a",null,2]}', ("l", ["a", None, None]), [("l[]", 3, "string", "bigint", "2", "type")]),
    ('{"l":"a"}', ("l", None), [("l", None, "array", "string", "a", "type")]),
    ('{"ol":[{"id":"a","left":"1990"},{"n":"x"}]}', ("ol", [("a", None), (None, None)]),
     [("ol[].n", 2, "long", "string", "x", "type")]),
    ('{"ol":[5]}', ("ol", [None]), [("ol[]", 1, "object", "bigint", "5", "type")]),
    ('{"m":{"k":{"x":"v"}}}', ("m", {"k": ("v",)}), []),
    ('{"m":{"k":{"x":1}}}', ("m", {"k": (None,)}), [("m.*.x", None, "string", "bigint", "1", "type")]),
    ('{"zzz":1}', ("s", None), []),
]


def test_permissive(documents, schema):
    parsed = documents(*[text for text, _, _ in CASES])
    rows = {r.path: r for r in conform(parsed, "doc", schema, keep=["path"]).collect()}
    places = {}
    for place in violations(parsed.withColumnRenamed("path", "file"), "doc", schema, keep=["file"]).collect():
        places.setdefault(place[0], []).append(tuple(place)[1:])
    for i, (text, (name, expected), found) in enumerate(CASES):
        path = f"/data/{i}.json"
        assert rows[path][name] == expected, text
        assert places.get(path, []) == found, text


def test_strict_passes_what_fits(documents, schema):
    fitting = [(text, value) for text, value, found in CASES if not any(f[-1] == "type" for f in found)]
    rows = conform(documents(*[text for text, _ in fitting]), "doc", schema, mode="strict").collect()
    for row, (text, (name, expected)) in zip(rows, fitting):
        assert row[name] == expected, text


@pytest.mark.parametrize("text", ['{"s":1}', '{"o":{"p":{"d":false}}}', '{"ol":[{"n":"x"}]}', '{"l":"a"}'])
def test_strict_fails_on_a_mismatch(documents, schema, text):
    with pytest.raises(PySparkException, match="expected"):
        conform(documents(text), "doc", schema, mode="strict").collect()


def test_compat_takes_booleans_as_doubles(documents, schema):
    rows = conform(documents('{"d":true}', '{"d":false}'), "doc", schema, mode="compat").collect()
    assert [r.d for r in rows] == [1.0, 0.0]


def test_conforming_twice_equals_once(documents, schema):
    parsed = documents(*[text for text, _, _ in CASES])
    once = conform(parsed, "doc", schema)
    again = once.select(F.to_variant_object(F.struct("*")).alias("doc"))
    assert conform(again, "doc", schema).collect() == once.collect()


def test_declared_order_and_width(spark):
    assert len(country_schema()) == 33 and len(block_schema()) == 24
    assert country_schema().names[:3] == ["code", "name", "iso3code"]


def test_unknown_mode(documents, schema):
    with pytest.raises(ValueError):
        conform(documents("{}"), "doc", schema, mode="other")


def test_inference_merges_types(documents):
    merged = infer_schema(documents('{"a":1}', '{"a":"x","b":[1]}'), "doc").first()[0]
    assert merged == "OBJECT<a: VARIANT, b: ARRAY<BIGINT>>"


def test_observed_paths_count_every_member(documents):
    parsed = documents('{"a":{"x":1,"y":[]},"l":[{"k":1},{"k":"s"},7],"e":{}}', "[1]", '{"a":null}', '"s"')
    rows = {(r.path, r.type): r.n for r in observed_paths(parsed, "doc").collect()}
    assert rows == {
        ("a", "OBJECT"): 1, ("a.x", "BIGINT"): 1, ("a.y", "ARRAY"): 1, ("l", "ARRAY"): 1,
        ("l[]", "OBJECT"): 2, ("l[]", "BIGINT"): 1, ("l[].k", "BIGINT"): 1, ("l[].k", "STRING"): 1,
        ("e", "OBJECT"): 1, ("[]", "BIGINT"): 1, ("a", "VOID"): 1,
    }


@pytest.mark.parametrize("levels", [1, 4, 5, 9])
def test_drift_reads_no_deeper_than_needed(spark, documents, monkeypatch, levels):
    text = "1"
    for i in range(levels, 0, -1):
        text = '{"k%d":%s}' % (i, text) if i % 2 else "[%s]" % text
    depths, real = [], drift_module._paths
    monkeypatch.setattr(drift_module, "_paths", lambda df, doc, depth: depths.append(depth) or real(df, doc, depth))
    rows = {(r.path, r.type): r.n for r in observed_paths(documents(text, "{}"), "doc").collect()}
    assert depths == [4, 8, 16][: len(depths)] and len(depths) == 1 + (levels > 4) + (levels > 8)
    assert len(rows) == levels and rows == {(r.path, r.type): r.n for r in observed_paths(documents(text, "{}"), "doc", 12).collect()}


def test_drift_stops_at_the_depth_bound_with_the_container(documents):
    rows = observed_paths(documents('{"a":{"b":{"c":1}}}'), "doc", depth=2).collect()
    assert {(r.path, r.type) for r in rows} == {("a", "OBJECT"), ("a.b", "OBJECT")}


def test_drift_reports_undeclared_only(documents, schema):
    rows = drift(documents('{"s":"x","ol":[{"id":"a","left":"1"}],"notes":"n"}'), "doc", schema).collect()
    assert {(r.path, r.type) for r in rows} == {("ol[].left", "STRING"), ("notes", "STRING")}
    assert "ol[].id" in declared_paths(schema)


def test_drift_reaches_every_level_and_takes_map_keys_as_declared(documents):
    deep = '{"a":{"b":{"c":{"d":{"e":{"f":{"g":1}}}}}}}'
    assert "a.b.c.d.e.f.g" in {r.path for r in observed_paths(documents(deep), "doc").collect()}
    schema = T.StructType().add("names", T.MapType(T.StringType(), T.StringType()))
    found = {r.path for r in drift(documents('{"names":{"en":"x","de":"y"},"other":{"en":1}}'), "doc", schema).collect()}
    assert found == {"other", "other.en"}
