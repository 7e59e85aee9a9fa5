from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cartulary.functions.text import entity_id, similar_names, well_formed_url
from cartulary.operators.links import check_route, probe_outcomes
from cartulary.plans.validate import validate

LINK = '{"url":"https://www.wikidata.org/wiki/Q2","type":"wikidata"}'
DOCS = [
    '{"id":"OK","name":"n","links":[' + LINK + '],"wikidata_id":"Q2"}',
    '{"id":"NODICT","links":["x"]}',
    '{"id":"NOURL","links":[{}]}',
    '{"id":"NULLURL","links":[{"url":null,"type":"website"}]}',
    '{"id":"NOTYPE","links":[{"url":"http://a.example/"}]}',
    '{"id":"RELATIVE","links":[{"url":"/a","type":"website"}]}',
    '{"id":"NOQ","links":[{"url":"http://wikidata.org/x","type":"wikidata"}]}',
    '{"id":"MISMATCH","links":[' + LINK + '],"wikidata_id":"Q1"}',
    '{"id":"MISSING","links":[' + LINK + '],"wikidata_id":null}',
    '{"id":"FORMAT","links":[' + LINK + '],"wikidata_id":"P1"}',
    '{"id":"ZERO","wikidata_id":"Q0"}',
    '{"name":"no id","links":[7]}',
    "{}",
    "null",
    '{"k": 8',
    "[1]",
    '"text"',
    '{"id":"NULLS","links":null,"wikidata_id":"P1"}',
    '{"id":"NUMBER","links":5}',
    '{"id":"KEYS","links":{"url":"http://a.example/"}}',
    '{"id":"CHARS","links":"ab"}',
]
EXPECTED = {
    0: [],
    1: ["Link 1: Invalid format (not a dictionary)"],
    2: ["Link 1: Missing URL"],
    3: ["Link 1: Missing URL"],
    4: ["Link 1: Missing type"],
    5: ["Link 1 (website): Invalid URL format - /a"],
    6: ["Link 1 (wikidata): Could not extract Q-number from URL: http://wikidata.org/x"],
    7: ["wikidata_id (Q1) doesn't match any wikidata link Q-numbers: ['Q2']"],
    8: ["Has wikidata link(s) but no wikidata_id field. Q-numbers found: ['Q2']"],
    9: ["wikidata_id has invalid format: P1"],
    10: [],
    11: ["Link 1: Invalid format (not a dictionary)"],
    12: ["File is empty or contains only null"],
    13: ["File is empty or contains only null"],
    14: ["Error: malformed document"],
    15: ["Error: the document is no object but of type array"],
    16: ["Error: the document is no object but of type string"],
    17: ["Error: the links are no list but of type null"],
    18: ["Error: the links are no list but of type integer"],
    19: ["Link 1: Invalid format (not a dictionary)"],
    20: ["Link 1: Invalid format (not a dictionary)", "Link 2: Invalid format (not a dictionary)"],
}


def messages(findings):
    rows = findings.orderBy("path", "ordinal").collect()
    found = {i: [] for i in EXPECTED}
    for row in rows:
        found[int(row.path.removeprefix("/data/").removesuffix(".json"))].append(row.message)
    return found


def test_offline_findings(documents):
    checked = validate(documents(*DOCS))
    assert messages(checked.findings) == EXPECTED
    verdicts = {r.path: (r.n_findings, r.valid) for r in checked.verdicts.collect()}
    assert verdicts == {f"/data/{i}.json": (len(m), not m) for i, m in EXPECTED.items()}
    totals = checked.totals().first()
    assert (totals.n_valid, totals.n_invalid, totals.n_findings) == (2, 19, 20)
    assert totals.n_valid + totals.n_invalid == len(DOCS)
    classes = {r.finding_class: r.n for r in checked.histogram().collect()}
    assert classes == {"Other errors": 13, "URL format errors": 3, "Wikidata errors": 4}


def test_urls_are_not_checked_when_switched_off(documents):
    assert messages(validate(documents(*DOCS), check_urls=False).findings)[5] == []


def test_report_ends_with_the_rest(documents):
    rows = validate(documents(*DOCS)).report(3, "/data").collect()
    assert [r.path for r in rows] == ["1.json", "11.json", "12.json", None]
    assert rows[-1].message == "... and 17 more errors"
    assert validate(documents(*DOCS[:2])).report(3, "/data").count() == 1


def test_online_findings(spark, documents):
    docs = [
        '{"id":"A","name":"Some Union","wikidata_id":"Q1","links":[{"url":"http://down.example/","type":"website"},'
        '{"url":"http://moved.example/","type":"website"},{"url":"http://head.example/","type":"website"},'
        '{"url":"http://late.example/","type":"website"},{"url":"https://en.wikipedia.org/x","type":"wikipedia"}]}',
        '{"id":"B","name":"Gone","wikidata_id":"Q404"}',
        '{"id":"C","name":"Flagged","wikidata_id":"Q5"}',
        '{"id":"D","name":"Other thing","wikidata_id":"Q6"}',
        '{"id":"E","wikidata_id":"Q404"}',
        '{"id":"F","name":"x","wikidata_id":"nonsense"}',
        '{"id":"G","name":"Anything","wikidata_id":"Q7"}',
    ]
    probes = spark.createDataFrame(
        [
            ("http://down.example/", "HEAD", 503, None),
            ("http://moved.example/", "HEAD", 301, None),
            ("http://head.example/", "HEAD", 405, None),
            ("http://head.example/", "GET", 200, None),
            ("http://late.example/", "HEAD", None, "timeout"),
            ("https://en.wikipedia.org/x", "HEAD", None, "timeout"),
        ],
        "url string, method string, status int, error string",
    )
    labels = spark.createDataFrame(
        [("Q1", "the some union of x", False), ("Q5", "Flagged", True), ("Q6", "Unrelated", None), ("Q7", None, None)],
        "qid string, label string, missing boolean",
    )
    checked = validate(documents(*docs), probes, labels)
    rows = [(r.entity_id, r.message) for r in checked.findings.orderBy("path", "ordinal").collect()]
    assert rows == [
        ("A", "Link 1 (website): HTTP 503 - http://down.example/"),
        ("A", "Link 4 (website): Request timeout - http://late.example/"),
        ("A", "Link 5 (wikipedia): timeout - https://en.wikipedia.org/x"),
        ("B", "wikidata_id validation: Entity Q404 not found in Wikidata"),
        ("C", "wikidata_id validation: Entity Q5 not found in Wikidata"),
        ("D", "wikidata_id validation: Name mismatch: Wikidata label is 'Unrelated', entity name is 'Other thing'"),
        ("F", "wikidata_id has invalid format: nonsense"),
    ]
    verdicts = [(r.n_findings, r.valid) for r in checked.verdicts.orderBy("path").collect()]
    assert verdicts == [(3, False), (1, False), (1, False), (1, False), (0, True), (1, False), (0, True)]


def test_the_latest_probe_up_to_the_check_counts(spark):
    at = "2024-06-01"
    rows = [
        ("a", "HEAD", "2024-05-01", 404, None), ("a", "HEAD", "2024-05-02", 200, None), ("b", "HEAD", "2024-05-02", 200, None), ("b", "HEAD", "2024-05-03", 404, None),
        ("c", "HEAD", "2020-01-01", 200, None), ("d", "HEAD", "2024-05-01", 405, None), ("d", "GET", "2024-04-01", 500, None), ("d", "GET", "2024-05-01", 200, None),
        ("e", "HEAD", "2024-05-01", 200, None), ("e", "HEAD", "2024-07-01", 500, None), ("f", "HEAD", "2024-05-01", None, "timeout"), ("g", "HEAD", "2024-05-01", 200, None),
        ("g", "HEAD", "2024-05-01", 404, None), ("g", "HEAD", "2024-05-01", 200, None),
    ]
    probes = spark.createDataFrame(rows, "url string, method string, at_text string, status int, error string").withColumn("probed_at", F.to_timestamp("at_text")).drop("at_text")
    links = spark.createDataFrame([(u, "head_then_get") for u in "aabcdefgh"], "url string, route string")
    now, year = F.to_timestamp(F.lit(at)), F.make_dt_interval(F.lit(365))
    found = {r.url: (r.ok, r.problem) for r in probe_outcomes(links, probes, now, year).collect()}
    assert found == {
        "a": (True, None), "b": (False, "HTTP 404"), "c": (None, None), "d": (True, None), "e": (True, None),
        "f": (False, "Request timeout"), "g": (False, "HTTP 404"), "h": (None, None),
    }
    assert probe_outcomes(links, probes, now, year).count() == links.count()
    timed = links.withColumn("checked", F.when(F.col("url") == "a", F.to_timestamp(F.lit("2024-05-01 12:00:00"))).otherwise(F.to_timestamp(F.lit("2024-08-01"))))
    later = {r.url: r.ok for r in probe_outcomes(timed, probes, F.col("checked")).collect()}
    assert later["a"] is False and later["e"] is False and later["c"] is True


def test_not_checked_is_not_valid(spark, documents):
    docs = ['{"id":"%s","links":[%s]}' % (i, ",".join('{"url":"http://%s/","type":"website"}' % u for u in urls)) for i, urls in enumerate([["good"], ["good", "new"], ["bad", "new"], []])]
    probes = spark.createDataFrame([("http://good/", "HEAD", 200, None), ("http://bad/", "HEAD", 404, None)], "url string, method string, status int, error string")
    checked = validate(documents(*docs), probes)
    rows = [(r.n_findings, r.n_unchecked, r.valid) for r in checked.verdicts.orderBy("path").collect()]
    assert rows == [(0, 0, True), (0, 1, None), (1, 1, False), (0, 0, True)]
    assert checked.totals().first().asDict() == {"n_valid": 2, "n_invalid": 1, "n_undecided": 1, "n_unchecked": 2, "n_findings": 1}


def test_a_link_without_its_probe_is_undecided(spark):
    links = spark.createDataFrame([("http://a/", "head"), ("http://b/", "head_then_get")], "url string, route string")
    probes = spark.createDataFrame([("http://b/", "HEAD", 405, None)], "url string, method string, status int, error string")
    assert [r.ok for r in probe_outcomes(links, probes).orderBy("url").collect()] == [None, None]


@pytest.mark.parametrize(
    "name,label,expected",
    [
        ("a b c d e f g h i j", "a b c q r s t u v w", False),
        ("a b c d e f g h i j", "a b c d r s t u v w", True),
        ("abc", "the abc union", True),
        ("The  ABC Union", "abc union", True),
        ("   ", "anything", True),
        ("x", None, True),
        ("x", "", True),
        ("x", "y", False),
        ("a a a b", "c b", True),
    ],
)
def test_similar_names(spark, name, label, expected):
    df = spark.createDataFrame([(name, label)], "name string, label string")
    assert df.select(similar_names(F.col("name"), F.col("label"))).first()[0] is expected


def test_urls(spark):
    urls = {
        "http://a.example/": (True, "head_then_get"), "/a": (False, "invalid"), "//a.example/x": (False, "invalid"),
        "mailto:a@b": (False, "invalid"), "https://x.wikidata.org/Q1": (True, "entity"), "http:///x": (False, "invalid"),
        "https://en.wikipedia.org/wikidata.org": (True, "entity"), "https://en.wikipedia.org/": (True, "head"),
    }
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    rows = df.select("u", well_formed_url(F.col("u")), check_route(F.col("u"))).collect()
    assert {r[0]: (r[1], r[2]) for r in rows} == urls
    ids = spark.createDataFrame([("http://w/Q12?x=Q3",), ("http://w/q1",)], "u string").select(entity_id(F.col("u")))
    assert [r[0] for r in ids.collect()] == ["Q12", None]
