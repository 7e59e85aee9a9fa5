"""Quality rules: counts against brute force, verdicts against an own computation of the fences."""

from __future__ import annotations

import random
import re
from collections import Counter

from cartulary.llm import quality as q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered.update(range(i, i + 8))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def counts_of(df):
    return sorted(((r.doc_id, *(r[c] for c in q.COUNTS), r.base_failed) for r in df.collect()), key=str)


def want_of(rows):
    out = []
    for i, text in rows:
        n = brute(text)
        out.append((i, *n, n[0] < 20 or 100 * n[4] > 30 * n[0]))
    return sorted(out, key=str)


def with_groups(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_counts(spark):
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(12))
    rows = []
    for i in range(80):
        parts = [rng.choice([passage, passage[3:], "#$ <a> & b", "line\n", "line\n", "\n\t\n", "é ü", " ".join(f"w{rng.randint(0, 9)}" for _ in range(30))]) for _ in range(rng.randint(0, 9))]
        rows.append((i, rng.choice([" ", "\n", "\x0b"]).join(parts), "en", "a"))
    assert counts_of(q.quality_rules(with_groups(spark, rows))) == want_of([r[:2] for r in rows])


def test_odd_rows(spark, odd):
    rows = [(*r, lang, None) for r, lang in zip(odd.select("doc_id", "text").collect(), [None, "en"] * 10, strict=False)]
    docs = with_groups(spark, rows)
    assert counts_of(q.quality_rules(docs)) == want_of([r[:2] for r in rows])
    assert q.quality_rules(docs.limit(0)).count() == 0
    clashing = docs.selectExpr("*", "1 AS n_words", "2 AS kept", "3 AS counts", "4 AS fences", "5 AS row")
    judged = q.judge(clashing).select("row.*")
    assert judged.columns == clashing.columns and judged.count() == len(rows)


def test_thresholds_follow_the_group(spark):
    rng, rows = random.Random(5), []
    for i in range(900):
        source, length = ("long", 12) if i % 3 == 0 else ("short", 4)
        words = ["".join(rng.choices("abcdefghij", k=length + rng.randint(-1, 1))) for _ in range(60)]
        if i in (30, 31):  # a third as long, or three times as long, as usual in its source
            words = [w * 4 if i == 31 else w[:3] for w in words]
        if i == 40:
            words = [w + "#$%" for w in words]
        rows.append((i, " ".join(words), "en", source))
    rows += [(1000 + i, rows[i * 3][1], "en", "rare") for i in range(4)]
    kept = {r.doc_id: r.kept for r in q.quality_rules(with_groups(spark, rows)).collect()}
    assert {i for i, k in kept.items() if not k} == {30, 31, 40}  # the rare source is judged with its language
    sketches = q.sketch(q.count_words(with_groups(spark, rows)))
    whole = {(r.measure, r.bin): r.n for r in q.merge(sketches).collect()}
    parts = Counter()
    for r in sketches.collect():
        parts[r.measure, r.bin] += r.n
    assert whole == parts
