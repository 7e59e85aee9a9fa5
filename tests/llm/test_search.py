"""Ranked search against a score of every document for every item."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from compare import bags, connect

from cartulary.llm import lexical_search as method
from cartulary.llm import sql
from cartulary.llm.lexical_search import Best, Documents, Items, hashed_terms, lexical_search, op13_lexical_search, pieces, search

SF_DIR = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, n long, terms string, doc int"
ITEMS = "item_id long, text string, item int, rank int"


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    bags = [(k, Counter(terms(t))) for k, t in docs]
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for doc, bag in bags:
            score = 0
            for term in terms(text):
                if bag[term]:
                    m = 100 - 25 + 25 * bag.total() * n_docs // n_terms
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += weight * (10**9 * bag[term] // (1000 * bag[term] + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, i + 1, None if none else doc, -score) for i, (score, none, doc) in enumerate(sorted(scored)[:20])]
    return sorted(out, key=str)


def got(spark, docs, items, *sizes):
    found = lexical_search(spark.createDataFrame([(*d, 1, "x", 2) for d in docs], DOCS), spark.createDataFrame([(*i, 1, 2) for i in items], ITEMS), *sizes)
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_table_equals_sql(spark):
    names, mine, columns, theirs = bags(op13_lexical_search(spark, SF_DIR), connect(SF_DIR), sql.ORACLE["op13_lexical_search"])
    assert names == columns and mine == theirs


def some(seed, n_docs, n_items, words=60):
    rng = random.Random(seed)
    vocabulary = [f"W{i}" if i % 5 else f"é{i}" for i in range(words)]
    text = lambda n: " ".join(vocabulary[min(int(rng.expovariate(0.1)), words - 1)] + rng.choice(["", ".", ",", "-x"]) for _ in range(n))
    docs = [(i, text(rng.randint(0, 40))) for i in range(n_docs)]
    docs += [(n_docs + i, docs[7][1]) for i in range(30)]
    rng.shuffle(docs)
    return docs, [(i, text(rng.randint(1, 25))) for i in range(n_items)]


@pytest.mark.parametrize(("batch", "fan"), [(4_096, 8), (50, 2), (1, 3)])
def test_equals_all_scores(spark, batch, fan):
    docs, items = some(1, 300, 20)
    assert got(spark, docs, items, batch, fan) == brute(docs, items)


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(method, "BLOCK_BYTES", 400)
    docs, items = some(2, 60, 12)
    assert got(spark, docs, items) == brute(docs, items)


def test_odd_rows(spark):
    docs = [
        (1, None), (2, ""), (3, " ., \n"), (None, "Alpha beta"), (None, "alpha BETA"), (5, "alpha"), (5, "alpha"), (4, "alpha"), (6, "Ünïcode ß alpha-beta_gamma"),
        (7, "beta " * 70_000), (8, "x" * 300_000), (9, "ALPHA\x00beta"), (10, "ÄÖ äö"), (-3, "beta"), (2**62, "gamma"),
    ]
    items = [(1, "alpha Beta"), (1, "alpha Beta"), (None, "gamma gamma"), (2, None), (3, ""), (4, "nowhere"), (5, "?!"), (6, "äö"), (7, "ÄÖ")]
    assert got(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = some(3, 9, 3)
    assert got(spark, [], items) == [] and got(spark, docs, []) == [] and got(spark, [], []) == []


def test_long_texts_come_in_pieces():
    text = "Alpha, " * 400 + "ü" * 999 + "; " + "b1 " * 300
    found = [hashed_terms(raw, offsets) for raw, offsets, _ in pieces(pa.array([text]), 64)]
    whole = hashed_terms(*method.text_bytes(pa.array([text])))
    assert len(found) > 20 and np.array_equal(np.concatenate([h for h, _ in found]), whole[0])


def test_batches_are_passed_over():
    """Of two groups of documents, one cannot reach what the other has: few of its scores are computed."""
    rng = np.random.default_rng(4)
    n, v = 4_096, 200
    owner = np.repeat(np.arange(n), 6)
    term = (rng.integers(0, 20, len(owner)) + np.where(owner < 200, 0, 100)).astype(np.int64)
    owner, term, _ = method._total((owner, term), np.ones(len(owner), np.int64), np.add)
    value = rng.integers(1, 1000, len(term))
    weight = np.full(v, 7, np.int64)
    item = np.repeat(np.arange(16), 5)
    asked = np.concatenate([rng.choice(20, 5, replace=False) for _ in range(16)]).astype(np.int64)
    items = Items(list(range(16)), item, asked, np.full(80, 7, np.int64), np.ones(v, np.int64))
    best = Best(16)
    scored = search(items, Documents(np.arange(n), owner, term, value, weight), best, np.zeros(v, np.int64))
    assert scored < 16 * n / 10
    full = np.zeros((n, v), np.int64)
    full[owner, term] = value
    for i, k in enumerate(items.ids):
        want = np.zeros(v, np.int64)
        want[asked[item == k]] = 7
        assert best.score[i].tolist() == sorted((full @ want).tolist(), reverse=True)[:20]
