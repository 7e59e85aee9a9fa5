"""Line dedup against brute force."""

from __future__ import annotations

import hashlib

import numpy as np

from cartulary.llm.line_dedup import bit_places, line_dedup, op4_line_dedup, twice_seen
from cartulary.llm.shared import keyed

SF_DIR = "/root/testdata/sf0.001"
NO_ID = float("inf")


def brute(rows, min_chars=40, min_docs=5):
    def key(line):
        line = line.strip(" \t\n\v\f\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)

    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(NO_ID if i is None else i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == (NO_ID if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in df.collect()), key=str)


def test_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    want = [(i, n, d, hashlib.sha256(k.encode()).hexdigest()) for i, n, d, k in brute(rows)]
    found = op4_line_dedup(spark, SF_DIR).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in found), key=str) == sorted(want, key=str)
    assert sum(w[2] for w in want) > 0


def test_keys_ties_and_holders(docs):
    line = "A line that is long enough to be judged, Ü" + "x" * 10
    rows = [(i, f"own {i}\n\t{line if i % 2 else line.lower()} \r\n{line}\n\n") for i in range(4)]
    assert got(line_dedup(docs(*rows))) == brute(rows)
    rows += [(9, line), (9, line), (9, "other\n" + line), (None, line), (None, line + "\n" + line)]
    assert got(line_dedup(docs(*rows))) == brute(rows)
    assert any(r[2] for r in brute(rows))


def test_odd_rows(odd, nothing):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert got(line_dedup(odd, 3, 2)) == brute(rows, 3, 2)
    assert line_dedup(nothing).count() == 0


def test_small_filter_changes_nothing(docs):
    rows = [(i, "\n".join(f"line number {j} of the text" for j in range(i, 40 + i))) for i in range(40)]
    assert got(line_dedup(docs(*rows), 10, 5, bits=6)) == got(line_dedup(docs(*rows), 10, 5)) == brute(rows, 10, 5)


def test_filter_holds_what_was_seen_twice(spark, docs):
    rows = [(i, f"common line of all\nline of {i} alone") for i in range(50)]
    frame = keyed(docs(*rows)).repartition(7)
    bits = np.unpackbits(twice_seen(frame, 5, 20).ravel())
    assert 3 <= bits.sum() <= 9
    assert bit_places(np.arange(5, dtype=np.uint64), 20).max() < 1 << 20
