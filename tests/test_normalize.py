from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from cartulary.operators.conform import conform
from cartulary.operators.enrich import canonical_code, canonical_language
from cartulary.operators.normalize import normalise, rules_for
from cartulary.schemas import block_schema, block_type_schema


def normal(documents, text, dataset="intblocks", **options):
    df = normalise(documents(text), "doc", rules_for(dataset, **options))
    return json.loads(df.select(F.to_json("doc")).first()[0])


CASES = [
    ('{"id":"B1","includes":[{"id":false}]}', {"id": "B1", "includes": [{"id": "no"}]}),
    ('{"id":true}', {"id": "yes"}),
    ('{"id":"B2","languages":["en",false]}', {"id": "B2", "languages": ["en", "no"]}),
    ('{"languages":[7,1.5,null]}', {"languages": ["7", "1.5", "None"]}),
    ('{"wikidata_id":null}', {"wikidata_id": ""}),
    ('{"id":"B5"}', {"id": "B5"}),
    ('{"partof":"X"}', {"partof": ["X"]}),
    ('{"partof":null}', {"partof": []}),
    ('{"partof":{"id":"X","name":"Y"}}', {"partof": ["X"]}),
    ('{"partof":[{"id":"X"},"Z"]}', {"partof": ["X", "Z"]}),
    ('{"headquarters":{"coordinates":{"lat":null,"lng":3.5}}}', {"headquarters": {"coordinates": {"lat": 0.0, "lng": 3.5}}}),
    ('{"headquarters":{"coordinates":null,"city":null}}', {"headquarters": {"coordinates": None, "city": ""}}),
    ('{"headquarters":"text"}', {"headquarters": "text"}),
    ('{"links":["x",{"url":null}]}', {"links": ["x", {"url": ""}]}),
    ('{"links":null}', {"links": None}),
    ('{"translations":["x",{"lang":false,"name":null}]}', {"translations": [{"lang": "no", "name": None}]}),
    ('{"notes":null,"extra":{"a":false}}', {"notes": None, "extra": {"a": False}}),
    ('{"membership_count":3}', {"membership_count": 3}),
]


def test_block_rules(documents):
    df = normalise(documents(*[text for text, _ in CASES]), "doc", rules_for("intblocks"))
    rows = [json.loads(r[0]) for r in df.select(F.to_json("doc")).collect()]
    assert rows == [expected for _, expected in CASES]


def test_compat_takes_the_keys_of_an_object(documents):
    assert normal(documents, '{"partof":{"id":"X","name":"Y"}}', compat=True) == {"partof": ["id", "name"]}


def test_coordinates_can_stay_null(documents):
    text = '{"headquarters":{"coordinates":{"lat":true,"lng":null}}}'
    place = normal(documents, text, coordinates="null")["headquarters"]["coordinates"]
    assert place == {"lat": None, "lng": None}


def test_block_types(documents):
    assert normal(documents, '{"id":false,"name":null,"other_names":null}', "blocktypes") == {
        "id": "no", "name": "", "other_names": [],
    }
    names = '{"other_names":[{"lang":false,"name":null}]}'
    assert normal(documents, names, "blocktypes") == {"other_names": [{"lang": "no", "name": ""}]}


def test_countries_are_left_alone(documents):
    assert normal(documents, '{"code":false,"name":null}', "countries") == {"code": False, "name": None}


def test_unknown_dataset():
    with pytest.raises(ValueError):
        rules_for("other")


def test_normalising_twice_changes_nothing(documents):
    texts = [text for text, _ in CASES]
    rules = rules_for("intblocks")
    once = normalise(documents(*texts), "doc", rules)
    twice = normalise(once, "doc", rules)
    assert [r[0] for r in once.select(F.to_json("doc")).collect()] == [
        r[0] for r in twice.select(F.to_json("doc")).collect()
    ]


@pytest.mark.parametrize("compat", [False, True])
def test_reading_through_rules_equals_normalising_first(documents, compat):
    parsed = documents(*[text for text, _ in CASES])
    rules = rules_for("intblocks", compat)
    direct = conform(parsed, "doc", block_schema(), rules=rules, keep=["path"]).collect()
    staged = conform(normalise(parsed, "doc", rules), "doc", block_schema(), keep=["path"]).collect()
    assert direct == staged


def test_block_types_read_through_rules(documents):
    parsed = documents('{"id":false,"other_names":null}', '{"id":"a","other_names":[{"lang":true}]}', '{"id":"b"}')
    rows = conform(parsed, "doc", block_type_schema(), rules=rules_for("blocktypes")).collect()
    assert [r.id for r in rows] == ["no", "a", "b"]
    assert rows[0].other_names == [] and rows[1].other_names[0].lang == "yes" and rows[2].other_names is None


def test_codes_are_repaired_before_joins(spark):
    df = spark.createDataFrame([("no ", "NO"), ("7", "No"), ("012", "en")], "code string, lang string")
    rows = df.select(canonical_code(F.col("code")), canonical_language(F.col("lang"))).collect()
    assert [tuple(r) for r in rows] == [("NO", "no"), ("007", "no"), ("012", "en")]
