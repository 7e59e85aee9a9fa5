from __future__ import annotations

import time

from cartulary.operators.constraints import check_constraints, from_json_schema

ZIP = "^[0-9]{5}$"
# A parcel, made up so that every keyword occurs.
SCHEMA = {
    "type": "object",
    "required": ["tracking"],
    "properties": {
        "tracking": {"type": "string", "minLength": 3, "maxLength": 6},
        "fragile": {"type": "boolean"},
        "grams": {"type": "integer", "minimum": 1},
        "service": {"type": "string", "enum": ["air", "sea", "rail"]},
        "stamps": {"type": "array", "minItems": 2, "items": {"type": "integer"}},
        "receiver": {
            "type": "object",
            "required": ["street"],
            "properties": {"street": {"type": "string"}, "zip": {"type": ["string", "null"], "pattern": ZIP}},
        },
        "stops": {
            "type": "array",
            "items": {
                "type": "object",
                "required": ["depot"],
                "properties": {"depot": {"type": "string", "pattern": "^D"}, "photo": {"type": "string", "format": "uri"}},
            },
        },
        "size": {
            "oneOf": [
                {"type": "integer"},
                {"type": "object", "required": ["width", "height"], "properties": {"width": {"type": "integer"}}},
            ]
        },
    },
}
OK = '"tracking":"ABC"'

CASES = [
    ("{" + OK + "}", []),
    ("{}", [("required", "tracking", None)]),
    ('{"tracking":"AB"}', [("length", "tracking", None)]),
    ('{"tracking":"ABCDEFG"}', [("length", "tracking", None)]),
    ('{"tracking":17}', [("type", "tracking", None)]),
    ("{" + OK + ',"fragile":"yes"}', [("type", "fragile", None)]),
    ("{" + OK + ',"grams":0}', [("minimum", "grams", None)]),
    ("{" + OK + ',"grams":12.0}', []),
    ("{" + OK + ',"grams":12.5}', [("type", "grams", None)]),
    ("{" + OK + ',"grams":true}', [("type", "grams", None)]),
    ("{" + OK + ',"service":"road"}', [("enum", "service", None)]),
    ("{" + OK + ',"stamps":[4]}', [("min_items", "stamps", None)]),
    ("{" + OK + ',"stamps":[4,"x",6]}', [("type", "stamps[]", 2)]),
    ("{" + OK + ',"stamps":null}', [("type", "stamps", None)]),
    ("{" + OK + ',"receiver":{}}', [("required", "receiver.street", None)]),
    ("{" + OK + ',"receiver":{"street":"s","zip":null}}', []),
    ("{" + OK + ',"receiver":{"street":"s","zip":"123"}}', [("pattern", "receiver.zip", None)]),
    ("{" + OK + ',"receiver":{"street":"s","zip":12345}}', [("nullable_type", "receiver.zip", None)]),
    ("{" + OK + ',"stops":[{"depot":"D1","photo":"http://a.example/p"},{"photo":"/p"},{"depot":"x"}]}',
     [("required", "stops[].depot", 2), ("uri", "stops[].photo", 2), ("pattern", "stops[].depot", 3)]),
    ("{" + OK + ',"size":3}', []),
    ("{" + OK + ',"size":{"width":1,"height":"tall"}}', []),
    ("{" + OK + ',"size":{"width":1}}', [("one_of", "size", None)]),
    ("{" + OK + ',"size":{"width":"w","height":1}}', [("one_of", "size", None)]),
    ("{" + OK + ',"size":"XL"}', [("one_of", "size", None)]),
]


def test_json_schema(documents):
    parsed = documents(*[text for text, _ in CASES]).withColumnRenamed("path", "file")
    places = {}
    for r in check_constraints(parsed, "doc", from_json_schema(SCHEMA), ["file"]).collect():
        places.setdefault(r.file, []).append((r.rule, r.path, r.position))
    for i, (text, expected) in enumerate(CASES):
        found = places.get(f"/data/{i}.json", [])
        assert sorted(map(str, found)) == sorted(map(str, expected)), text


def test_findings_do_not_depend_on_partitions(documents):
    parsed = documents(*[text for text, _ in CASES])
    rules = from_json_schema(SCHEMA)
    one = check_constraints(parsed.coalesce(1), "doc", rules, ["text"]).collect()
    many = check_constraints(parsed.repartition(7), "doc", rules, ["text"]).collect()
    assert sorted(map(str, one)) == sorted(map(str, many))


def test_lists_in_lists(documents):
    schema = {"type": "object", "properties": {"grid": {"type": "array", "items": {"type": "array", "minItems": 1, "items": {"type": "integer"}}}}}
    rows = check_constraints(documents('{"grid":[[1],[],[2,"x"]]}'), "doc", from_json_schema(schema), ["path"]).toDF("file", "rule", "path", "position", "value").collect()
    assert sorted((r.rule, r.path, r.position) for r in rows) == [("min_items", "grid[]", 2), ("type", "grid[][]", 3)]


def test_a_whole_schema_plans_and_runs_quickly(documents):
    """Over a hundred constraints, most of them within lists: each list is opened once."""
    leaf = {"type": "string", "minLength": 2, "pattern": "^[a-z]"}
    row = {"type": "object", "required": ["a", "b"], "properties": {n: leaf for n in "abcdef"}}
    schema = {"type": "object", "properties": {f"list{i}": {"type": "array", "minItems": 1, "items": row} for i in range(5)} | {"one": row}}
    rules = from_json_schema(schema)
    assert len(rules) > 100
    text = '{"list0":[{"a":"ok","b":"ok"},{"a":"X","c":1}],"one":{"a":"ok","b":"ok"}}'
    parsed = documents(*[text] * 200)
    check_constraints(parsed.limit(1), "doc", rules[:3], ["text"]).collect()
    start = time.time()
    found = check_constraints(parsed, "doc", rules, ["text"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert time.time() - start < 10  # some three seconds on an idle machine
    assert len(found.collect()) == 200 * 4  # b is missing; X is short and no small letter; 1 is no text
    assert plan.count("ArrayTransform") <= 30 or plan.count("transform(") <= 30
