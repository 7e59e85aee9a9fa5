"""Rows that share an id and the 32-bit hash of their texts are still told apart."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from test_lines import brute as lines
from test_lines import got as lines_of
from test_substrings import brute_bytes, brute_words, order

import corpus_pipeline as cp
from cartulary.llm.line_dedup import line_dedup
from cartulary.llm.shared import keyed
from cartulary.llm.substring_dedup import substring_dedup
from cartulary.llm.suffix_dedup import suffix_dedup

LINE = "a line that many documents hold and that is long enough for thirteen words and for fifty bytes"
PAIR = [f"{LINE}\nfirst 32382", "second 120387 " + "its own words " * 12]


@pytest.fixture(params=[5, None])
def rows(request):
    return [*((i, f"{LINE}\nnumber {i}") for i in range(5)), *((request.param, t) for t in PAIR)]


def test_pair_collides_in_32_bits(docs, rows):
    pair = docs(*rows[5:])
    assert pair.select(F.hash("text").alias("h")).distinct().count() == 1
    assert keyed(pair).select("doc", "salt").distinct().count() == 2


def test_lines(docs, rows):
    rows.append((9 if rows[5][0] else None, f"{LINE}\nlast"))  # the keeper of the line
    assert lines_of(line_dedup(docs(*rows))) == lines(rows)


def test_substrings(docs, rows):
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring_dedup(docs(*rows)).collect()]
    assert order(got) == order(brute_words(rows))
    got = [(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in suffix_dedup(docs(*rows)).collect()]
    assert order(got) == order(brute_bytes(rows))


def test_pipeline_keeps_both(spark, docs):
    pair = [(None, t) for t in PAIR]
    assert sorted(r.text for r in cp.drop_near_duplicates(spark, docs(*pair), "").collect()) == sorted(PAIR)
