"""Substring dedup over words and bytes against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from cartulary.llm import repeats
from cartulary.llm.anchors import pick_anchors
from cartulary.llm.arrays import BYTE_VALUES
from cartulary.llm.shared import store
from cartulary.llm.substring_dedup import op1_substring_dedup, substring_dedup
from cartulary.llm.suffix_dedup import match, op3_suffix_dedup, suffix_dedup

SF_DIR = "/root/testdata/sf0.001"
NO_ID = float("inf")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(rows, split, window):
    """(id, kept, removed flags) of each row."""
    first = {}
    for i, text in rows:
        items, key = split(text), NO_ID if i is None else i
        for s in range(len(items) - window + 1):
            w = tuple(items[s : s + window]) if isinstance(items, list) else items[s : s + window]
            first[w] = min(first.get(w, NO_ID), key)
    out = []
    for i, text in rows:
        items, key = split(text), NO_ID if i is None else i
        gone = [False] * len(items)
        for s in range(len(items) - window + 1):
            w = tuple(items[s : s + window]) if isinstance(items, list) else items[s : s + window]
            if first[w] < key:
                gone[s : s + window] = [True] * window
        out.append((i, items, gone))
    return out


def brute_words(rows):
    return [(i, len(x), sum(g), " ".join(w for w, f in zip(x, g, strict=True) if not f)) for i, x, g in brute(rows, words, 13)]


def brute_bytes(rows):
    out = []
    for i, x, g in brute(rows, lambda t: (t or "").encode(), 50):
        n_spans = sum(f and not p for f, p in zip(g, [False, *g], strict=False))
        out.append((i, len(x), sum(g), n_spans, bytes(b for b, f in zip(x, g, strict=True) if not f)))
    return out


def order(rows):
    return sorted(rows, key=str)


def made(seed):
    """Documents that share passages at odd places."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    passages = [" ".join(rng.choices(vocabulary, k=rng.randint(5, 40))) for _ in range(12)]
    rows = []
    for i in rng.sample(range(1000), 60):
        text = " ".join(rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choices(vocabulary, k=rng.randint(1, 20))) for _ in range(rng.randint(0, 9)))
        rows.append((i, text[rng.randint(0, 5) :]))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_made_documents(docs, seed):
    rows = made(seed)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring_dedup(docs(*rows)).collect()]
    assert order(got) == order(brute_words(rows))
    got = [(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in suffix_dedup(docs(*rows)).collect()]
    assert order(got) == order(brute_bytes(rows))


def test_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in op1_substring_dedup(spark, SF_DIR).collect()]
    want = [(i, n, g, hashlib.sha256(k.encode()).hexdigest()) for i, n, g, k in brute_words(rows)]
    assert order(got) == order(want) and sum(w[2] for w in want) > 0
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op3_suffix_dedup(spark, SF_DIR).collect()]
    want = [(i, n, g, s, hashlib.sha256(k).hexdigest()) for i, n, g, s, k in brute_bytes(rows)]
    assert order(got) == order(want) and sum(w[2] for w in want) > 0


def test_odd_rows(odd, nothing):
    ODD = odd.select("doc_id", "text").collect()

    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring_dedup(odd).collect()]
    assert order(got) == order(brute_words(ODD))
    got = [(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in suffix_dedup(odd).collect()]
    assert order(got) == order(brute_bytes(ODD))
    assert substring_dedup(nothing).count() == suffix_dedup(nothing).count() == 0


def test_levels_merge_geometrically():
    rng = np.random.default_rng(3)
    values = rng.integers(97, 99, 3000).astype(np.uint8)
    size = np.full(300, 10)
    docs = np.sort(rng.integers(0, 40, 300))
    rows = [values[i * 10 : i * 10 + 10].tobytes() for i in range(300)]
    first = {}
    for d, r in zip(docs, rows, strict=True):
        for s in range(4):
            first.setdefault(r[s : s + 7], d)
    want = [first[r[s : s + 7]] < d for d, r in zip(docs, rows, strict=True) for s in range(4)]
    for batch in (1, 7, 64, 1000):
        assert match(values, size, docs, 7, batch).tolist() == want


def test_every_window_has_its_anchor():
    rng = np.random.default_rng(5)
    raw = rng.integers(97, 100, 2000).astype(np.uint8)
    offsets = np.array([0, 10, 10, 700, 2000])
    found = pick_anchors(BYTE_VALUES[raw], offsets, 50, 16)
    windows = [w for a, b in zip(found.first, found.last, strict=True) for w in range(a, b + 1)]
    assert windows == [w for a, b in zip(offsets[:-1], offsets[1:], strict=True) for w in range(a, b - 49)]
    assert ((found.at >= found.last) & (found.at <= found.first + 34)).all()


def test_buckets_are_as_many_as_asked():
    """A million buckets are all in use, and bucket and rest tell all fingerprints apart."""
    prints = np.random.default_rng(3).integers(0, 1 << 63, 4_000_000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    bucket, rest = repeats.bucket_of(prints, 1_000_000)
    assert len(np.unique(bucket)) > 950_000 and np.bincount(bucket.astype(np.int64)).max() < 40
    assert len(np.unique(bucket * np.uint64(1 << 44) + rest)) == len(np.unique(prints)) and int(rest.max()) < 1 << 48


def test_anchors_leave_no_shuffle_files(spark):
    """They are removed once the replies are written; the setting is as before afterwards."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, seen = spark.conf.get(name), []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(repeats, "store", lambda df, _: seen.append(spark.conf.get(name)) or store(df, "replies"))
        op3_suffix_dedup(spark, SF_DIR)
    assert seen == ["true"] and spark.conf.get(name) == before
