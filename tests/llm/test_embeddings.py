"""Vector classes against all pairs of each label."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from compare import bags, connect

from cartulary.llm import embedding_dedup as method
from cartulary.llm import sql
from cartulary.llm.embedding_dedup import embedding_dedup, op12_embedding_dedup, parts, rotation

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int, node long, part string, n int"


def brute(rows, cosine=0.98):
    def fit(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    units = [np.array(v) / max(map(abs, v)) if label is not None and fit(v) else None for _, v, label in rows]
    units = [None if u is None else u / np.sqrt(u @ u) for u in units]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= cosine:
                links[i], links[j] = links[i] + 1, links[j] + 1
                root[find(i)] = find(j)
    least = {}
    for i, (k, _, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return sorted(((k, links[i], least.get(find(i)), k is not None and k == least.get(find(i))) for i, (k, _, _) in enumerate(rows)), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame([(k, v, label, 3, "x", 5) for k, v, label in rows], SCHEMA)


def near(rng, base, cosine, n):
    """Vectors of about this cosine to ``base``."""
    out = []
    for _ in range(n):
        side = rng.standard_normal(len(base))
        side -= side @ base / (base @ base) * base
        side *= np.linalg.norm(base) / np.linalg.norm(side)
        out.append((cosine * base + math.sqrt(1 - cosine**2) * side) * rng.uniform(0.1, 9))
    return out


def groups(seed, dim, sizes, labels=2):
    rng = np.random.default_rng(seed)
    rows = []
    for size in sizes:
        base, label = rng.standard_normal(dim), int(rng.integers(labels))
        for cosine in (0.9999, 0.991, 0.98 + 1e-9, 0.98 - 1e-9, 0.979, 0.985):
            rows += [(v, label) for v in near(rng, base, cosine, size)]
        rows += [(base, label), (base, label), (-base, label), (base * 2, 1 - label)]
    order = rng.permutation(len(rows))
    return [(int(k) * 3, [float(x) for x in rows[i][0]], rows[i][1]) for k, i in enumerate(order)]


@pytest.mark.parametrize(("dim", "sizes"), [(64, [1, 3, 9, 40]), (5, [2, 12]), (1, [3]), (100, [4, 4]), (8, [25])])
def test_equals_all_pairs(spark, dim, sizes):
    rows = groups(dim, dim, sizes)
    assert got(embedding_dedup(table(spark, rows))) == brute(rows)


@pytest.mark.parametrize("cell", [7, 40])
def test_chunks_and_depth_change_nothing(spark, monkeypatch, cell):
    """Small cells: the grid takes all coordinates, and cells of near copies are dealt into many chunks."""
    monkeypatch.setattr(method, "CELL", cell)
    rows = groups(3, 64, [20, 5], labels=1)
    assert got(embedding_dedup(table(spark, rows))) == brute(rows)


def test_a_ball_touches_no_cell_that_is_not_visited():
    """Of any two points within the radius each visits the other's home cell."""
    rng = np.random.default_rng(6)
    for dim in (8, 64):
        radius = parts(dim, 0.98)[0][1]
        x = np.rint(rng.uniform(-9000, 9000, (400, dim))).astype("<i2")
        step = rng.standard_normal(x.shape)
        columns = parts(dim, 0.98)[0][0]
        step *= (radius - 1) / np.linalg.norm(step[:, columns], axis=1)[:, None]
        y = np.rint(x + step).astype("<i2")
        y[:, columns][((x[:, columns].astype(float) - y[:, columns]) ** 2).sum(1) > radius**2] = x[:, columns][((x[:, columns].astype(float) - y[:, columns]) ** 2).sum(1) > radius**2]
        seen = []
        for rows in (x, y):
            n = len(rows)
            batch = pa.RecordBatch.from_arrays(
                [pa.array(["l"] * n), pa.array([dim] * n, pa.int32()), pa.array(range(n), pa.int64()), pa.array([1] * n, pa.int64()), pa.array([r.tobytes() for r in rows], pa.binary())],
                ["label", "dim", "node", "copies", "part"],
            )
            found = [r for b in method._visits(0.98, 3, True)(iter([batch])) for r in b.to_pylist() if r["number"] == 0]
            seen.append(({(r["node"], r["cell"]) for r in found}, {r["node"]: r["cell"] for r in found if r["home"]}))
            assert len(found) == len(seen[-1][0])
        for mine, other in (seen, seen[::-1]):
            assert all((node, cell) in mine[0] for node, cell in other[1].items())


def test_chain(spark):
    """Links in a row: one component, though its ends are far from each other."""
    rows = [(100 - i, [math.cos(i * 0.19), math.sin(i * 0.19), 0.0], 1) for i in range(30)]
    assert got(embedding_dedup(table(spark, rows))) == brute(rows)
    assert {r[2] for r in brute(rows)} == {71}


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    v = [1.0, 2.0, -3.0]
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0, 0.0], 1), (4, [1.0, None, 2.0], 1), (5, [1.0, nan, 2.0], 1), (6, [inf, 1.0, 1.0], 1),
        (7, v, None), (8, v, None), (9, v, 1), (9, v, 1), (None, v, 1), (None, [9.0, 1.0, 1.0], 1), (10, [1.0, 2.0], 1), (11, [2.0, 4.0], 1),
        (12, [1e300, 2e300, -3e300], 1), (13, [1e-300, 2e-300, -3e-300], 1), (14, [-0.0, 0.0, 1.0], 2), (15, [0.0, 0.0, 1.0], 2), (16, v, 3),
        (None, [5.0, 0.0, 0.0], 4), (None, [5.0, 0.0, 0.0], 4),
    ]
    assert got(embedding_dedup(table(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert embedding_dedup(table(spark, []).limit(0)).collect() == []


def test_table_equals_sql(spark):
    names, mine, columns, theirs = bags(op12_embedding_dedup(spark, SF_DIR), connect(SF_DIR), sql.ORACLE["op12_embedding_dedup"])
    assert names == columns and mine == theirs


def test_budgets():
    """Some part of any two near vectors is within its budget, in integers."""
    rng = np.random.default_rng(5)
    for dim in (3, 8, 30, 64):
        for _ in range(200):
            base = rng.standard_normal(dim)
            x, y = (np.rint(v / np.linalg.norm(v) @ rotation(dim) * method.SCALE) for v in (base, near(rng, base, 0.98 + 1e-12, 1)[0]))
            assert any(((x[c] - y[c]) ** 2).sum() <= r * r for c, r in parts(dim, 0.98))
