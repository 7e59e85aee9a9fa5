"""Leaks of benchmark items against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from cartulary.llm import decontamination as d

SF_DIR = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def bag(part):
    return Counter(tuple(part[i : i + 5]) for i in range(max(1, len(part) - 4)))


def brute(docs, items):
    out = []
    for doc, text in docs:
        w = words(text)
        every = {k for n in range(1, 6) for i in range(len(w) - n + 1) for k in [tuple(w[i : i + n])]}
        for item, wanted in items:
            v = words(wanted)
            if not v or not w or (len(w) < len(v) and len(w) < 5):
                continue
            n, b, best = min(len(v), len(w)), bag(v), 0
            if sum(c for k, c in b.items() if k in every) < 0.8 * b.total():
                continue
            for s in range(len(w) - n + 1):
                a = bag(w[s : s + n])
                best = max(best, (a & b).total() / (a | b).total())
            if best >= 0.8:
                out.append((doc, item, round(best, 9)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.item_id, round(r.similarity, 9)) for r in df.collect()), key=str)


def rows(spark, name, key):
    return [(r[key], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/{name}.parquet").collect()]


def test_table(spark):
    want = brute(rows(spark, "documents", "doc_id"), rows(spark, "benchmark", "item_id"))
    assert got(d.op7_decontamination(spark, SF_DIR)) == want and want


@pytest.fixture
def planted():
    rng = random.Random(2)
    vocabulary = [f"v{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 4, 5, 6, 14, 30, 60])))) for i in range(30)]
    items += [(40, None), (41, ""), (42, " \n"), (43, items[5][1]), (None, items[6][1] + " more")]
    docs = []
    for i in range(60):
        part = words(rng.choice(items[:30])[1])
        if len(part) > 20 and i % 2:
            part[rng.randint(0, 1)] = "changed"
        filler = lambda: rng.choices(vocabulary, k=rng.randint(0, 40))
        docs.append((i, "\n".join([*filler(), *part, *filler()]).upper() if i % 3 else " ".join(part[: len(part) - i % 2])))
    return docs, items


def test_planted(spark, docs, planted, monkeypatch):
    texts, items = planted
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = brute(texts, items)
    assert got(d.find_leaks(docs(*texts), benchmark)) == want and len(want) > 60
    monkeypatch.setattr(d, "ITEMS", 7)
    assert got(d.find_leaks(docs(*texts), benchmark)) == want
    left = d.decontaminate(docs(*texts), benchmark)
    assert sorted(r.doc_id for r in left.collect()) == sorted({i for i, _ in texts} - {w[0] for w in want})
    assert left.columns == docs(*texts).columns


def test_odd_rows(spark, odd, nothing):
    items = [(1, "no id here no id here no id here"), (2, "z"), (3, "one two three four"), (4, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    texts = [tuple(r) for r in odd.select("doc_id", "text").where("length(text) < 100000 or text is null").collect()]
    short = odd.where("length(text) < 100000 or text is null")
    assert got(d.find_leaks(short, benchmark)) == brute(texts, items)
    assert d.find_leaks(odd, benchmark).count() == len(brute(texts, items))
    assert d.find_leaks(nothing, benchmark).count() == d.find_leaks(odd, benchmark.limit(0)).count() == 0
    assert d.decontaminate(odd, benchmark.limit(0)).count() == odd.count()


def test_multi_index_returns_all_within_the_radius():
    rng = np.random.default_rng(1)
    items = d.index_items(tuple((i, " ".join(f"t{x}" for x in rng.integers(0, 50, 20))) for i in range(80)))
    prints = items.prints[rng.integers(0, 80, 300)].copy()
    for i in range(len(prints)):
        for bit in rng.choice(64, rng.integers(0, 30), replace=False):
            prints[i] ^= np.uint64(1 << int(bit))
    window, item = d._candidates(items, 20, prints)
    want = {(w, i) for w in range(300) for i in range(80) if int(prints[w] ^ items.prints[i]).bit_count() <= d.RADIUS}
    assert set(zip(window.tolist(), item.tolist(), strict=True)) == want and len(want) > 100
