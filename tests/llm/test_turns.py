"""Turn repair against a plain dynamic programme and, for short conversations, against all edits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from cartulary.llm import turn_repair as method
from cartulary.llm.turn_repair import ACCEPTED, NEXT, START, Code, Ways, damaged, decide, mark, op11_turn_repair, repair, search

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, place int, audit string, conv int"


def cheapest(rows, start=START, ends=ACCEPTED):
    """Row by row: the least cost and audit of each state."""
    best = {start: (0, "")}

    def inserted(best):
        for _ in range(3):
            for q, (cost, audit) in list(best.items()):
                for c, to in NEXT[q].items():
                    if c != "s":
                        best[to] = min(best.get(to, (cost + 3, audit + "I")), (cost + 3, audit + "I"))
        return best

    best = inserted(best)
    for row in rows:
        after = {}
        for q, (cost, audit) in best.items():
            ways = [(4, "D", q)]
            if not row.must_go:
                more = 3 * row.cut_short
                ways += [(more, "K", to) for c, to in NEXT[q].items() if c == row.initial]
                ways += [(3 + more, "R", to) for c, to in NEXT[q].items() if c != "s"]
            for step, letter, to in ways:
                after[to] = min(after.get(to, (cost + step, audit + letter)), (cost + step, audit + letter))
        best = inserted(after)
    return min((best[q] for q in ends if q in best), default=None)


def enumerated(rows):
    """All edits of each row with up to three insertions before it and at the end."""
    found = []
    fills = ["", "u", "a", "ua", "au", "uau", "aua"]
    for edits in product("DKua", repeat=len(rows)):
        for gaps in product(fills, repeat=len(rows) + 1):
            roles, audit, cost = "", "", 0
            for row, edit, gap in zip(rows, edits, gaps, strict=False):
                roles, audit, cost = roles + gap, audit + "I" * len(gap), cost + 3 * len(gap)
                if edit == "D":
                    audit, cost = audit + "D", cost + 4
                elif row.must_go:
                    break
                else:
                    roles += row.initial if edit == "K" else edit
                    audit, cost = audit + ("K" if edit == "K" else "R"), cost + 3 * (edit != "K") + 3 * row.cut_short
            else:
                roles, audit, cost = roles + gaps[-1], audit + "I" * len(gaps[-1]), cost + 3 * len(gaps[-1])
                if re.fullmatch("(s?(ua)+)?", roles):
                    found.append((cost, audit))
    return min(found)


def some(rng, n, initials="suax"):
    return [Code(rng.choice(initials), rng.random() < 0.2, rng.random() < 0.3) for _ in range(n)]


def test_search_equals_all_edits():
    rng = random.Random(11)
    for n in (0, 1, 2, 3):
        for _ in range(25 if n < 3 else 8):
            rows = some(rng, n)
            assert search(rows, START, ACCEPTED) == enumerated(rows) == cheapest(rows), rows


def test_search_equals_dynamic_programme():
    rng = random.Random(12)
    for _ in range(400):
        rows = some(rng, rng.randint(0, 14), rng.choice(["suax", "ua", "u", "ssu", "a"]))
        assert search(rows, START, ACCEPTED) == cheapest(rows), rows
        start, end = rng.randrange(4), (rng.randrange(4),)
        assert search(rows, start, end) == cheapest(rows, start, end), (rows, start, end)


@pytest.mark.parametrize("segment", [1, 2, 5])
def test_segments_change_nothing(monkeypatch, segment):
    monkeypatch.setattr(method, "SEGMENT", segment)
    rng = random.Random(13)
    for _ in range(120):
        rows = some(rng, rng.randint(0, 17), rng.choice(["suax", "ua", "u", "a"]))
        ways = Ways()
        for row in rows:
            ways.add(row)
        assert ways.finish() == cheapest(rows), rows


def test_long_conversation():
    rng = random.Random(14)
    rows = some(rng, 1_500, "sua")
    ways = Ways()
    for row in rows:
        ways.add(row)
    assert ways.finish() == cheapest(rows)


def brute(rows):
    """The contract, conversation by conversation; rows are ``conv, turn, role, text``."""
    convs = {}
    for conv, turn, role, text in rows:
        shown = [" " if x is None else str(x) for x in (conv, turn)]
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(":".join(shown).encode()) % 20
        mine = convs.setdefault(conv, [])
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        mine.extend([(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    out = []
    for conv, mine in convs.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()[:16]))
        seen, counts, codes = set(), [0, 0, 0], []
        for _, role, text in mine:
            bare = text.strip(method.BLANKS)
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            codes.append(Code(role[:1], fault in (0, 1), fault == 2))
        cost, audit = cheapest(codes)
        illegal = sum(a.initial + b.initial not in ("su", "ua", "au") for a, b in zip(codes, codes[1:], strict=False))
        turns = [r[0] for r in mine if r[0] is not None]
        repaired, left, initial = [], list(mine), START
        for edit in audit:
            free = "user" if "u" in NEXT[initial] else "assistant"
            row = None if edit == "I" else left.pop(0)
            if edit == "D":
                continue
            role, text = (free, "") if row is None else (row[1] if edit == "K" else free, row[2])
            initial = NEXT[initial][role[:1]]
            repaired.append(f"{role}:{text}")
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest()))
    return sorted(out, key=str)


def through(spark, rows, tmp_path):
    spark.createDataFrame([(*r, 7, "x", 1) for r in rows], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    return sorted((tuple(r) for r in op11_turn_repair(spark, str(tmp_path)).collect()), key=str)


def test_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in op11_turn_repair(spark, SF_DIR).collect()), key=str) == brute(rows)


def test_odd_rows(spark, tmp_path):
    rng = random.Random(15)
    roles = ["system", "user", "assistant", "tool", "", None, "User", "supervisor"]
    texts = [None, "", " \n", "Yes.", "Yes. ", "no", "?", "é ü.", "a" * 200_000, "x\x00y!", "Same text."]
    rows = [(conv, rng.choice([None, *range(8)]), rng.choice(roles), rng.choice(texts)) for conv in [None, *range(60)] for _ in range(rng.randint(1, 12))]
    rows += [(None, None, None, None), (99, 5, "user", "Twice."), (99, 5, "user", "Twice."), (99, 7, "user", "Twice."), (99, 2**62, "assistant", "Late.")]
    rows += [(100, i, rng.choice(roles[:3]), rng.choice(texts)) for i in range(700)]
    assert through(spark, rows, tmp_path) == brute(rows)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    found = op11_turn_repair(spark, str(tmp_path))
    assert found.collect() == [] and found.columns[0] == "conv_id" and found.columns[-1] == "repaired_sha256"


def test_repaired_turns(spark):
    """The operator on its own: turns as rows, without damage."""
    turns = spark.createDataFrame([(1, 1, "user", "Hello."), (1, 2, "user", "Are you there?"), (1, 3, "assistant", " "), (2, 1, "assistant", "Well.")], "conv_id long, turn long, role string, text string")
    marked = mark(turns)
    report = decide(marked)
    assert {r.conv_id: (r.cost, r.audit) for r in report.collect()} == {1: (7, "KRD"), 2: (3, "IK")}
    found = [tuple(r) for r in repair(marked, report).orderBy("conv_id", "place").collect()]
    assert found == [(1, 0, "K", "user", "Hello."), (1, 1, "R", "assistant", "Are you there?"), (2, 0, "I", "user", ""), (2, 1, "K", "assistant", "Well.")]


def test_plan_moves_texts_once(spark):
    plan = damaged(spark.read.parquet(f"{SF_DIR}/conversations.parquet"))
    decided = decide(plan)._jdf.queryExecution().optimizedPlan().toString()
    assert "CartesianProduct" not in decided and "text" not in decided.split("RepartitionByExpression")[0]
