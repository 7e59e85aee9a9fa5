"""Repair of the turn structure of conversations, with the cheapest edits.

A conversation should read as an optional system turn and then pairs of user and assistant. Rows
that are blank or repeat an earlier row have to go; others may stay, change their role or go,
and turns without text may be put in between. The edit lattice has a node for every number of rows
consumed and every state of that grammar. Its cheapest path is found by Dijkstra's search from both
ends: two heaps grow until no pair of open nodes can be as cheap as the best meeting, so that all
meetings of that cost are known; of these the one with the least concatenated audit counts. An
audit is the row of initials ``D`` (delete), ``I`` (insert), ``K`` (keep), ``R`` (change of role).
Two audits of equal cost from one node to another never begin one another (the longer one would hold
more insertions), so the least of parts make up the least whole.

Longer conversations are searched ``SEGMENT`` rows at a time, between each two states at its ends; a
state keeps only its least cost and audit. Deciding needs codes of rows, not texts: the first exchange
carries role, digest and marks, and a second one brings each audit to its texts. Both stream through a
conversation in order, which is one task's work; besides the audit, which is part of the
result, its memory does not depend on the length. Repetitions are found beforehand by a grouped minimum.

Results for odd input: null role or text is one space; an empty role, or one that begins with anything
but ``s``, ``u`` or ``a``, cannot be kept; rows of a null conversation are one conversation; null turns
come first; rows of one turn are ordered by role and digest of the text; repeated rows are
duplicates; very long texts are read once and never compared; an empty table gives an empty result; other
columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.llm.shared import partitions, read, store

BLANKS = " \t\n\x0b\x0c\r"
RENAME, DELETE, INSERT, CUT_SHORT = 3, 4, 3, 3
# States of ``(s?(ua)+)?`` by what was read last, and where an initial leads from each.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
BEFORE = tuple({c: [q for q in range(4) if NEXT[q].get(c) == to] for c in "sua"} for to in range(4))
ACCEPTED = (START, ASSISTANT)
ROLES = {"u": "user", "a": "assistant"}
SEGMENT = 256


class Code(NamedTuple):
    """Of a row: the initial of its role, and whether it must go or was cut short."""

    initial: str
    must_go: bool
    cut_short: bool


Node = tuple[int, int]


def _out(rows: list[Code], node: Node) -> Iterator[tuple[int, str, Node]]:
    """Edits that lead on from a node: cost, initial, where to."""
    i, q = node
    for c, to in NEXT[q].items():
        if c != "s":
            yield INSERT, "I", (i, to)
    if i < len(rows):
        row = rows[i]
        yield DELETE, "D", (i + 1, q)
        if not row.must_go:
            more = CUT_SHORT * row.cut_short
            for c, to in NEXT[q].items():
                if c == row.initial:
                    yield more, "K", (i + 1, to)
                if c != "s":
                    yield RENAME + more, "R", (i + 1, to)


def _into(rows: list[Code], node: Node) -> Iterator[tuple[int, str, Node]]:
    """Edits that lead to a node: cost, initial, where from."""
    i, q = node
    back = BEFORE[q]
    for c in "ua":
        for q0 in back[c]:
            yield INSERT, "I", (i, q0)
    if i:
        row = rows[i - 1]
        yield DELETE, "D", (i - 1, q)
        if not row.must_go:
            more = CUT_SHORT * row.cut_short
            for q0 in back.get(row.initial, ()):
                yield more, "K", (i - 1, q0)
            for c in "ua":
                for q0 in back[c]:
                    yield RENAME + more, "R", (i - 1, q0)


def search(rows: list[Code], start: int, ends: tuple[int, ...]) -> tuple[int, str] | None:
    """Cost and audit of the cheapest edits from state ``start`` to one of ``ends``, least audit first; none if there are none.

    Keeping costs nothing, so of nodes at one cost those fewer rows from their side's origin come
    first: then a node's label is final when it leaves its heap.
    """
    n = len(rows)
    heaps: tuple[list, list] = ([(0, 0, "", (0, start))], [(0, 0, "", (n, q)) for q in ends])
    done: tuple[dict[Node, tuple[int, str]], dict[Node, tuple[int, str]]] = ({}, {})
    steps = (_out, _into)
    best, met = None, []
    while heaps[0] and heaps[1] and (best is None or heaps[0][0][0] + heaps[1][0][0] <= best):
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        cost, _, audit, node = heappop(heaps[side])
        mine, other = done[side], done[1 - side]
        if node in mine:
            continue
        mine[node] = (cost, audit)
        if node in other:
            met.append((cost + other[node][0], node, None))
        for step, letter, to in steps[side](rows, node):
            if to in other:
                met.append((cost + step + other[to][0], *((node, (letter, to)) if side == 0 else (to, (letter, node)))))
            if to not in mine:
                at = to[0] if side == 0 else n - to[0]
                heappush(heaps[side], (cost + step, at, audit + letter if side == 0 else letter + audit, to))
        if met:
            best = min(met[-1][0], best) if best is not None else min(m[0] for m in met)
            best = min(best, min(m[0] for m in met))
            met = [m for m in met if m[0] == best]
    if best is None:
        return None
    first, last = done
    return best, min(first[u][1] + last[u][1] if edge is None else first[u][1] + edge[0] + last[edge[1]][1] for _, u, edge in met)


class Ways:
    """The cheapest audit to each state after the rows so far."""

    def __init__(self) -> None:
        self.best: dict[int, tuple[int, str]] = {START: (0, "")}
        self.rows: list[Code] = []

    def add(self, row: Code) -> None:
        if len(self.rows) == SEGMENT:
            self.best = self._on([(q,) for q in range(4)])
            self.rows = []
        self.rows.append(row)

    def _on(self, ends: list[tuple[int, ...]]) -> dict[int, tuple[int, str]]:
        found: dict[int, tuple[int, str]] = {}
        for end in ends:
            ways = [(cost + more[0], audit + more[1]) for q, (cost, audit) in self.best.items() if (more := search(self.rows, q, end))]
            if ways:
                found[end[0]] = min(ways)
        return found

    def finish(self) -> tuple[int, str]:
        return self._on([ACCEPTED])[START]


REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
CODES = ("conv", "turn", "role", "digest", "copy", "blank", "cut_short", "again")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by conversation, in order; ``copy`` -1 marks a row that only names its conversation."""
    done: list[tuple] = []
    for conv, rows in groupby(_rows(batches), key=lambda r: r[0]):
        ways, counts = Ways(), [0, 0, 0, 0]
        before = last = low = high = None
        turns = 0
        for _, turn, role, digest, copy, blank, cut_short, again in rows:
            if copy < 0:
                continue
            if turn is not None and turn != high:
                low, high, turns = (turn if low is None else low), turn, turns + 1
            again = again or (turn, role, digest) == before
            before = (turn, role, digest)
            fault = 0 if blank else 1 if again else 2 if cut_short else None
            if fault is not None:
                counts[fault] += 1
            if last is not None and last + role[:1] not in ("su", "ua", "au"):
                counts[3] += 1
            last = role[:1]
            ways.add(Code(role[:1], fault in (0, 1), fault == 2))
        cost, audit = ways.finish()
        done.append((conv, high - low + 1 - turns if turns else 0, *counts, cost, audit))
        if len(done) == 1_000:
            yield _table(done)
            done = []
    yield _table(done)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 8
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.string() if i == 7 else pa.int64()) for i, c in enumerate(columns)],
        [f.split()[0] for f in REPORT.split(", ")],
    )


TURNS = "conv_id long, place long, edit string, role string, text string"


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each conversation come after its audit; turns go out as they are read."""
    kept: list[tuple] = []
    size = 0

    def flush() -> pa.RecordBatch:
        columns = list(zip(*kept, strict=True)) or [()] * 5
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [f.split()[0] for f in TURNS.split(", ")])

    for conv, rows in groupby(_rows(batches), key=lambda r: r[0]):
        audit, at, state, place = "", 0, START, 0
        for _, copy, role, text, given in _with_end(rows):
            if given is not None:
                audit = given
                continue
            if copy is not None and copy < 0:
                continue
            # what is put in before this row (at the end: all that is left), then the row
            while at < len(audit) and (audit[at] == "I" or copy is None):
                initial = "a" if state == USER else "u"
                kept.append((conv, place, "I", ROLES[initial], ""))
                at, state, place = at + 1, NEXT[state][initial], place + 1
            if copy is None:
                continue
            edit = audit[at]
            at += 1
            if edit != "D":
                initial = role[:1] if edit == "K" else "a" if state == USER else "u"
                kept.append((conv, place, edit, role if edit == "K" else ROLES[initial], text))
                state, place, size = NEXT[state][initial], place + 1, size + len(text)
            if len(kept) >= 5_000 or size > 4_000_000:
                yield flush()
                kept, size = [], 0
    yield flush()


def _with_end(rows: Iterator[tuple]) -> Iterator[tuple]:
    yield from rows
    yield None, None, None, None, None


def mark(turns: DataFrame, copies: Column | None = None) -> DataFrame:
    """``conv, turn, role, text, digest, copy, blank, cut_short`` of ``conv_id, turn, role, text``.

    ``copies`` is an array column of copy numbers (by default one copy, 0): each element gives a row,
    -1 one that only names its conversation.
    """
    text = F.rtrim("text", F.lit(BLANKS))
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        F.explode(F.array(F.lit(0)) if copies is None else copies).alias("copy"),
    )
    return rows.select(
        "*", F.unhex(F.substring(F.sha2("text", 256), 1, 32)).alias("digest"),
        (text == "").alias("blank"), (~F.right(text, F.lit(1)).isin(".", "!", "?")).alias("cut_short"),
    )


def decide(marked: DataFrame) -> DataFrame:
    """One row a conversation: its faults, and cost and audit of the edits that repair it."""
    spark = marked.sparkSession
    codes = marked.drop("text")
    at = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"))
    often = codes.where("copy >= 0").groupBy("conv", "role", "digest").agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first <> last")
    often = often.select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    found = codes.join(often, same, "left").withColumn("again", F.coalesce(at != F.col("first"), F.lit(False))).select(*CODES)
    return _in_order(found, partitions(spark)).mapInArrow(_judge, REPORT)


def _in_order(rows: DataFrame, n: int, *more: Column) -> DataFrame:
    order = (F.col("turn").asc_nulls_first(), "role", "digest", "copy")
    return rows.repartition(n, "conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), *more, *order)


def repair(marked: DataFrame, report: DataFrame) -> DataFrame:
    """The repaired turns: ``conv_id, place, edit, role, text``, each conversation in order within its partition."""
    rows = marked.select("conv", "turn", "role", "digest", "copy", "text", F.lit(None).cast("string").alias("audit"))
    audits = report.select(F.col("conv_id").alias("conv"), F.col("audit"))
    both = rows.unionByName(audits, allowMissingColumns=True)
    lines = _in_order(both, partitions(marked.sparkSession), F.col("audit").isNull())
    return lines.select("conv", "copy", "role", "text", "audit").mapInArrow(_apply, TURNS)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for conv, rows in groupby(_rows(batches), key=lambda r: r[0]):
        sha, between = hashlib.sha256(), b""
        for _, role, text in rows:
            sha.update(between + role.encode() + b":")
            sha.update(text.encode())
            between = b"\n"
        yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([sha.hexdigest()])], ["conv", "sha"])


def damaged(turns: DataFrame) -> DataFrame:
    """Rows of ``conversations`` with faults that depend on ``conv_id`` and ``turn``, marked."""
    key = F.concat(*[x if isinstance(x, Column) else F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("conv_id", F.lit(":"), "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = turns.select(
        "conv_id", "turn", kind.alias("kind"), F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
    )
    numbers = lambda *n: F.array(*[F.lit(i) for i in n])
    return mark(rows, F.when(F.col("kind") == 0, numbers(-1)).when(F.col("kind") == 3, numbers(0, 1)).otherwise(numbers(0)))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = damaged(read(spark, sf_dir, "conversations"))
    report = store(decide(marked), "reports")
    turns = repair(marked, report)
    digests = turns.select("conv_id", "role", "text").mapInArrow(_digest, "conv long, sha string")
    joined = report.join(digests, report.conv_id.eqNullSafe(digests.conv), "left")
    return joined.select(*report.columns, F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
