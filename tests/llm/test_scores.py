"""Context-tree weighting against a direct, sequential implementation of the trees."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from cartulary.llm import context_tree as ct


def tokens(text):
    lowered = "".join(chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch for ch in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered), lowered.encode() + b"\xff"


def held_out(i):
    return zlib.crc32(("null" if i is None else str(i)).encode()) % 7 == 2


def steps(data):
    """(context, node, bit) of each binary decision."""
    padded = b"\0" * ct.DEPTH + data
    for at in range(len(data)):
        context, node = padded[at : at + ct.DEPTH], 1
        for k in range(7, -1, -1):
            bit = data[at] >> k & 1
            yield context, node, bit
            node = node * 2 + bit


def brute(rows):
    counts, children = defaultdict(lambda: [0, 0]), defaultdict(set)
    words, n_train = Counter(), 0
    for i, text in rows:
        if not held_out(i):
            w, data = tokens(text)
            words.update(w)
            n_train += 1
            for context, node, bit in steps(data):
                for d in range(ct.DEPTH + 1):
                    counts[context[ct.DEPTH - d :], node][bit] += 1
                    if d:
                        children[context[ct.DEPTH - d + 1 :], node].add((context[ct.DEPTH - d :], node))
    total, vocabulary = words.total() + n_train, len(words) + (n_train > 0)
    weighted = {}

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    for key in sorted(counts, key=lambda k: -len(k[0])):
        own = kt(*counts[key])
        if len(key[0]) < ct.DEPTH:
            below = sum(weighted[c][0] for c in children[key])
            log_w = max(own, below) + math.log1p(math.exp(-abs(own - below))) - math.log(2)
            weighted[key] = (log_w, math.exp(own - math.log(2) - log_w))
        else:
            weighted[key] = (own, 1.0)

    def predict(context, node, bit):
        p, rest = 0.0, 1.0
        for d in range(ct.DEPTH + 1):
            key = (context[ct.DEPTH - d :], node)
            a = counts.get(key, [0, 0])
            stop = weighted[key][1] if key in weighted else (1.0 if d == ct.DEPTH else 0.5)
            p += rest * stop * (a[bit] + 0.5) / (sum(a) + 1)
            rest *= 1 - stop
        return p

    out = []
    for i, text in rows:
        w, data = tokens(text)
        known = sum(words[x] > 0 for x in w) + (n_train > 0)
        base = sum(math.log10((words[x] + 1) / (total + vocabulary + 1)) for x in w) + math.log10((n_train + 1) / (total + vocabulary + 1))
        out.append((i, held_out(i), len(w) + 1, known, total, base, sum(math.log10(predict(*s)) for s in steps(data))))
    return out


def compare(df, rows):
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in df.collect()), key=str)
    want = sorted(brute(rows), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(sorted(got), sorted(want), strict=True) if all(w[0] is not None for w in want) else zip(got, want, strict=True):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-6)


def test_table_sample(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text[:400]) for r in docs.collect()][:60]
    compare(ct.context_tree_scores(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_many_chunks_and_buckets_give_the_same(spark, monkeypatch):
    """Some thirty chunks: words and grams of one chunk are answered from many buckets."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text[:400]) for r in docs.collect()][:60]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(ct, "CHUNK_BYTES", 700)
    compare(ct.context_tree_scores(table), rows)


def test_no_table_of_the_model_goes_through_the_driver(spark):
    """Levels of trees join by sorting as planned and as run: a broadcast of them grows in the driver with the corpus."""
    found = ct.context_tree_scores(spark.createDataFrame([(i, f"some text {i}") for i in range(40)], "doc_id long, text string"))
    plan = found._jdf.queryExecution().executedPlan()
    for final in ("false", "true"):
        text = plan.toString()
        assert f"isFinalPlan={final}" in text and "SortMergeJoin" in text and "Broadcast" not in text
        assert len(found.collect()) == 40


def test_held_out_texts_are_coded_in_fewer_bits(spark):
    found = ct.op6_context_tree_scores(spark, "/root/testdata/sf0.001").collect()
    held = [r for r in found if r.held_out]
    assert len(found) == 200 and len(held) > 10
    assert sum(r.bits_per_byte for r in held) / len(held) < 5


def test_odd_rows(spark, odd, nothing):
    short = odd.where("length(text) < 9000 or text is null")
    rows = [tuple(r) for r in short.select("doc_id", "text").collect()]
    compare(ct.context_tree_scores(short), rows)
    assert ct.context_tree_scores(odd).count() == odd.count()
    assert ct.context_tree_scores(nothing).count() == 0
    none = spark.createDataFrame([(i, "Some text") for i in range(40) if held_out(i)], "doc_id long, text string")
    assert {round(r.score / math.log10(2)) for r in ct.context_tree_scores(none).collect()} == {-80}
