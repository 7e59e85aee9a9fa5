"""Near-duplicate classes against brute force, and signatures against exact similarity."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from cartulary.llm import minhash_dedup as method
from cartulary.llm.components import components
from cartulary.llm.minhash_dedup import COORDINATES, minhash_dedup, multiset, op2_minhash_dedup, shared_regions, signatures, similarity

SF_DIR = "/root/testdata/sf0.001"


def bag(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def brute(rows):
    bags, root = [bag(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and bags[j] and (bags[i] & bags[j]).total() >= 0.8 * (bags[i] | bags[j]).total():
                root[find(i)] = find(j)
    classes = {}
    for i in range(len(rows)):
        classes.setdefault(find(i), []).append(rows[i][0])
    least = {c: min((x for x in ids if x is not None), default=None) for c, ids in classes.items()}
    return sorted(((rows[i][0], least[find(i)], len(classes[find(i)])) for i in range(len(rows))), key=str)


def got(df):
    return sorted(((r.doc_id, r.class_id, r.class_size) for r in df.collect()), key=str)


def test_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    found = op2_minhash_dedup(spark, SF_DIR)
    assert got(found) == brute(rows)
    kept = Counter(r.class_id for r in found.collect() if r.is_kept)
    assert set(kept.values()) == {1} and len(kept) == len({b[1] for b in brute(rows)})


def test_chains_and_copies(docs):
    rng = random.Random(4)
    base = [f"w{rng.randint(0, 500)}" for _ in range(120)]
    rows, text = [], list(base)
    for i in range(12):  # a chain: each is near to the next, its ends are not near to each other
        rows.append((100 - i, " ".join(text)))
        text[i * 10] = f"new{i}"
        text[i * 10 + 1] = f"other{i}"
    rows += [(200 + i, rows[3][1]) for i in range(5)] + [(300 + i, f"short {i % 2} text") for i in range(4)]
    rng.shuffle(rows)
    assert got(minhash_dedup(docs(*rows))) == brute(rows)


def test_odd_rows(odd, nothing):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert got(minhash_dedup(odd)) == brute(rows)
    assert minhash_dedup(nothing).count() == 0


@pytest.mark.parametrize("weighted", [False, True])
def test_agreement_is_the_similarity(weighted):
    rng = np.random.default_rng(6)
    close = []
    for i in range(60):
        a = rng.integers(0, 1 << 60, rng.integers(3, 900)).astype(np.uint64)
        if weighted:
            a = np.concatenate((a, a[: len(a) // 2], a[: len(a) // 3]))
        b = np.concatenate((a[: int(len(a) * (0.5 + i / 130))], rng.integers(0, 1 << 60, 20).astype(np.uint64)))
        signed = signatures(np.concatenate((a, b)), np.array([len(a), len(b)]))
        exact = similarity(np.unique(a, return_counts=True), np.unique(b, return_counts=True))
        close.append((signed[0] == signed[1]).mean() - exact)
        assert signed.shape == (2, COORDINATES) and (signed != 0).all()
    assert abs(np.mean(close)) < 0.03 and np.std(close) < 0.1


def test_multiset_counts():
    values, counts = multiset("a b c d e a b c d e a b c d e")
    assert counts.sum() == 11 and len(values) == 5
    assert similarity(multiset("a b"), multiset("a  b\n")) == 1.0


def test_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(40)] + [(500, 501 + i) for i in range(50)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert dict(found) == {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert len(found) == len(dict(found))


@pytest.mark.parametrize("columns", [3, 4_096])
def test_shared_regions(monkeypatch, columns):
    monkeypatch.setattr(method, "COLUMNS", columns)
    rng = random.Random(8)
    lists = [rng.sample(range(60), rng.randint(0, 30)) for _ in range(25)]
    values = np.array([v for part in lists for v in part], np.int32)
    x, y = np.array([0, 3, 7, 24]), np.arange(25)
    found = shared_regions(values, np.array([len(part) for part in lists]), x, y)
    assert found.tolist() == [[len(set(lists[i]) & set(lists[j])) for j in y] for i in x]


def test_copies_without_their_original(docs, monkeypatch):
    """Near copies which no pivot joins, so that they meet in blocks, several a bucket."""
    monkeypatch.setattr(method, "BLOCK", 16)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(90):
        text = list(base)
        for place in rng.sample(range(200), rng.choice((2, 4, 5, 6, 8))):
            text[place] = f"x{i}_{place}"
        rows.append((i, " ".join(text)))
    rows += [(200 + i, f"{text} z z z") for i, text in rows[:20]]
    found = got(minhash_dedup(docs(*rows)))
    assert found == brute(rows)
    assert 10 < len({class_id for _, class_id, _ in found}) < 100
