"""Packing: token ids, exact coverage and little padding."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from cartulary.llm import packing as p
from cartulary.llm.tokens import PLAIN, Encoder

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(p.tokenizer_path())


def check(rows, found, tokenizer, length=p.LENGTH):
    """All ids once, sequences gapless; returns the share of padding."""
    want = defaultdict(list)
    for i, text in rows:
        want[i].append([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    expected = {i: sorted((s, len(ids[s : s + length]), zlib.crc32(np.array(ids[s : s + length], "<u4").tobytes()), len(ids)) for ids in every for s in range(0, len(ids), length)) for i, every in want.items()}
    assert {i: sorted(x) for i, x in pieces.items()} == expected
    used = []
    for places in sequences.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at
            at += size
        assert at <= length
        used.append(at)
    return 1 - sum(used) / (length * len(used))


def test_table(spark, tokenizer):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert check(rows, p.op10_packing(spark, SF_DIR).collect(), tokenizer) < 0.03


def test_odd_rows(odd, nothing, tokenizer):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    check(rows, p.pack(odd).collect(), tokenizer)
    check(rows, p.pack(odd, length=64).collect(), tokenizer, 64)
    assert p.pack(nothing).count() == 0


def test_pieces_are_the_tokenizers(tokenizer):
    rng = random.Random(7)
    units = ["'s", "'re", "'ll", "''", "  ", " ", "\n", " '", "don't", "'ve ", "1'm", "é", "!?", "\xa0", "\x1c", "'S", "a1", "\t"]
    base = [chr(c) for c in [*range(PLAIN), *range(0x2010, 0x2028)]]
    texts = ["".join(rng.choice(units) if rng.random() < 0.7 else rng.choice(base) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    texts += ["", "<|endoftext|> x", "日本 語", "’s “x” ", "'s", "a'"]
    encoder = Encoder(p.tokenizer_path())
    for ids, text in zip(encoder.encode(texts), texts, strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_histogram():
    rng = random.Random(3)
    for _ in range(20):
        histogram = {rng.randint(1, 100): rng.randint(1, 500) for _ in range(rng.randint(1, 30))}
        patterns = p.shortest_pack_first(histogram, 100)
        placed = defaultdict(int)
        for pattern, count in patterns:
            assert sum(pattern) <= 100 and count > 0
            for size in pattern:
                placed[size] += count
        assert placed == histogram
        ranks = defaultdict(list)
        for size, low, high, _, _ in p.places(patterns):
            ranks[size].append((low, high))
        for size, every in ranks.items():
            assert sorted(every)[0][0] == 0 and max(h for _, h in every) == histogram[size]
            assert all(a[1] == b[0] for a, b in zip(sorted(every), sorted(every)[1:], strict=False))
