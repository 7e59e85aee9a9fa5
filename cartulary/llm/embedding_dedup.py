"""Near-duplicate vectors by a join of their low-dimensional parts.

Unit vectors of cosine ``c`` are ``sqrt(2 - 2c)`` apart. They are rotated, so that no coordinate is
special, and cut into ``BLOCKS`` parts. By the pigeonhole principle two that are near are near in some
part: their squared distance there is within that part's share of the whole budget, in proportion to its
dimensions. So each part is range-joined on its own. A grid over the first coordinates of the part, with
cells a little wider than the ball, brings near ones together: a vector is at home in one cell and visits those
next to it that its ball touches, at most one on either axis. A pair counts in the first part that brings it together, for each of
the two at its home, so that links are counted where they are found and no list of pairs is made. Of
the links of a cell go out a count for each vector and edges that span what is connected, few however
many pairs there are.

Coordinates travel as 16-bit integers, in which distances are exact, so that all cells agree on them.
The rounding is bounded: distances clearly within or beyond the budget are decided at once, pairs
within the rounding of it by the cosine of the vectors as given, in double precision. No link is lost.

Equal vectors of one label are one node with a number of copies. The grid takes more coordinates the
more vectors a label has; a cell of more than ``CELL`` members is dealt into chunks, and each two
chunks meet in one place. Edges are joined to components by star contraction.

Results for odd input: vectors that are null, empty, zero or hold null, NaN or infinity link with
nothing, as do those without a label and those of different length; repeated rows are different vectors;
rows without an id count as links, but a component's id is its least id, null if it has none, and they
are not kept; ties of ids are all kept; an empty table gives an empty result; vectors of any length and
any size of components are taken; other columns of the input are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.llm.components import components
from cartulary.llm.shared import read, store

COSINE = 0.98
BLOCKS = 8
# Members of a cell (or of a chunk of it) that meet in one place; rows of them compared at once.
CELL, ROWS = 8_192, 256
# Units of a coordinate; the largest is 1.
SCALE = 32_000
# Beyond this the unit of a coordinate is too coarse for cells of a ball's width.
MOST_COSINE = 0.999_999
# A coordinate more leaves about so many times fewer vectors in a cell.
FEWER = 3
COUNT, EDGE, OPEN = range(3)


@lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same in all tasks."""
    q, _ = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q


@lru_cache(maxsize=32)
def parts(dim: int, cosine: float) -> list[tuple[slice, float]]:
    """Columns of each part, and the distance in units within which it must lie for some part of a link, rounding included."""
    n = min(BLOCKS, dim)
    ends = np.linspace(0, dim, n + 1).round().astype(int)
    return [
        (slice(a, b), math.sqrt((2 - 2 * cosine) * (b - a) / dim) * SCALE + 1.01 * math.sqrt(b - a) + 1)
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)
    ]


def _stack(column: pa.Array, kind: type, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim)


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = batch.column("dim").to_numpy(zero_copy_only=False)
    for dim in np.unique(dims):
        yield int(dim), batch.take(pa.array(np.flatnonzero(dims == dim)))


PREPARED = "label string, h1 long, h2 long, least long, copies long, dim int, part binary, exact binary"


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rotated unit vectors in integers, and the vectors in doubles, scaled by a power of two."""
    names = [f.split()[0] for f in PREPARED.split(", ")]
    for batch in batches:
        for dim, rows in _by_dim(batch):
            exact = rows.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            exact = np.ldexp(exact, -np.frexp(np.abs(exact).max(1))[1][:, None])
            unit = exact / np.sqrt(np.einsum("ij,ij->i", exact, exact))[:, None]
            part = np.rint(unit @ rotation(dim) * SCALE).astype("<i2")
            yield pa.RecordBatch.from_arrays([*(rows.column(n) for n in names[:6]), _binary(part), _binary(exact.astype("<f8"))], names)


def _visits(cosine: float, depth: int, full: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cells of each vector by part: its own, and those its ball touches in the first ``depth`` coordinates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, rows in _by_dim(batch):
                whole = _stack(rows.column("part"), "<i2", dim).astype(np.int64)
                for number, (columns, radius) in enumerate(parts(dim, cosine)):
                    wide = 2 * math.ceil(radius) + 1
                    at = whole[:, columns][:, :depth]
                    own = np.floor_divide(at, wide)
                    rest = at - own * wide
                    upper = rest > wide // 2
                    # steps to the nearer neighbour in each coordinate, as distances to it
                    away = np.where(upper, wide - rest, rest).astype(np.float64) ** 2
                    for subset in range(1 << at.shape[1]):
                        moved = np.array([bool(subset >> i & 1) for i in range(at.shape[1])])
                        which = np.flatnonzero(away[:, moved].sum(1) <= radius * radius)
                        if not len(which):
                            continue
                        cell = np.zeros(len(which), np.int64)
                        for i in range(at.shape[1]):
                            step = np.where(upper[which, i], 1, -1) if moved[i] else 0
                            cell = cell * 4_096 + (own[which, i] + step + 2_048)
                        take, n = pa.array(which), len(which)
                        keys = [rows.column("label").take(take), rows.column("dim").take(take), pa.array([number] * n, pa.int32()), pa.array(cell)]
                        names = ["label", "dim", "number", "cell"]
                        if full:
                            keys += [pa.array([subset == 0] * n), *(rows.column(c).take(take) for c in ("node", "copies", "part"))]
                            names += ["home", "node", "copies", "part"]
                        yield pa.RecordBatch.from_arrays(keys, names)

    return run


def _connected(near: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges to the least node of each component of a bipartite matrix; all rows and columns have links."""
    low, high = rows.copy(), columns.copy()
    most = np.iinfo(np.int64).max
    while True:
        found = np.minimum(low, np.where(near, high, most).min(1))
        high_found = np.minimum(high, np.where(near, found[:, None], most).min(0))
        if (found == low).all() and (high_found == high).all():
            break
        low, high = found, high_found
    a, b = np.concatenate((rows, columns)), np.concatenate((low, high))
    return a[a != b], b[a != b]


FOUND = "kind int, a long, b long, n long"


def meet(whole: np.ndarray, nodes: np.ndarray, copies: np.ndarray, home: np.ndarray, other: np.ndarray, number: int, cosine: float) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Links of the members ``home`` to the members ``other`` of one cell of part ``number``: counts, spanning edges, open pairs."""
    dim = whole.shape[1]
    places = parts(dim, cosine)
    distance, error = math.sqrt(2 - 2 * cosine) * SCALE, 1.01 * math.sqrt(dim) + 1
    surely, hardly = max(distance - error, 0) ** 2, (distance + error) ** 2

    def squared(i: np.ndarray, j: np.ndarray, columns: slice) -> np.ndarray:
        x, y = whole[i, columns], whole[j, columns]
        return np.einsum("ij,ij->i", x, x)[:, None] + np.einsum("ij,ij->i", y, y) - 2 * (x @ y.T)

    for start in range(0, len(home), ROWS):
        i, j = home[start : start + ROWS], other
        near = (squared(i, j, places[number][0]) <= places[number][1] ** 2) & (nodes[i][:, None] != nodes[j])
        for columns, radius in [*places[:number], (slice(None), None)]:
            rows, cols = near.any(1), near.any(0)
            i, j, near = i[rows], j[cols], near[rows][:, cols]
            if not near.size:
                break
            apart = squared(i, j, columns)
            near &= apart <= hardly if radius is None else apart > radius * radius
        if not near.any():
            continue
        unclear = near & (apart > surely)
        x, y = np.nonzero(unclear & (nodes[i][:, None] < nodes[j]))
        yield OPEN, nodes[i[x]], nodes[j[y]], np.zeros(len(x), np.int64)
        near &= ~unclear
        rows, cols = near.any(1), near.any(0)
        i, j, near = i[rows], j[cols], near[rows][:, cols]
        if near.size:
            yield COUNT, nodes[i], nodes[i], near @ copies[j]
            a, b = _connected(near, nodes[i], nodes[j])
            yield EDGE, a, b, np.zeros(len(a), np.int64)


def _tile(cosine: float) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        first = table.slice(0, 1).to_pylist()[0]
        whole = _stack(table.column("part"), "<i2", first["dim"]).astype(np.float64)
        nodes, copies = (table.column(c).to_numpy().astype(np.int64) for c in ("node", "copies"))
        chunk = table.column("chunk").to_numpy()
        home = np.flatnonzero(table.column("home").to_numpy() & (chunk == first["i"]))
        other = np.flatnonzero(chunk == first["j"])
        found = [(np.zeros(0, np.int64),) * 4]
        found += [(np.full(len(a), kind, np.int64), a, b, n) for kind, a, b, n in meet(whole, nodes, copies, home, other, first["number"], cosine)]
        kind, a, b, n = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.table({"kind": kind.astype(np.int32), "a": a, "b": b, "n": n})

    return run


def _verify(cosine: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, rows in _by_dim(batch):
                x, y = (_stack(rows.column(c), "<f8", dim) for c in ("exact", "exact2"))
                inner = lambda p, q: np.einsum("ij,ij->i", p, q)
                linked = np.flatnonzero(inner(x, y) / (np.sqrt(inner(x, x)) * np.sqrt(inner(y, y))) >= cosine)
                yield rows.select(["a", "b", "na", "nb"]).take(pa.array(linked))

    return run


def _keys(label: str, vector: Column) -> list[Column]:
    """Label (null where the vector links with nothing) and two hashes of the vector."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fit = vector.isNotNull() & F.exists(vector, lambda x: x != 0) & ~bad
    return [F.when(fit, F.col(label).cast("string")).alias("label"), F.xxhash64(vector).alias("h1"), F.xxhash64(F.lit(1), vector).alias("h2")]


def embedding_dedup(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of each row."""
    if not 0 < cosine <= MOST_COSINE:
        raise ValueError(f"no cosine between 0 and {MOST_COSINE}: {cosine}")
    vector = F.col(vector_col).cast("array<double>")
    keyed = rows.select(F.col(id_col).cast("long").alias("vec_id"), *_keys(label_col, vector), vector.alias("embedding"))
    keys = ["label", "h1", "h2"]
    different = keyed.where(F.col("label").isNotNull()).groupBy(*keys).agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    prepared = different.withColumn("dim", F.size("embedding")).mapInArrow(_prepare, PREPARED)
    vectors = store(prepared.withColumn("node", F.monotonically_increasing_id()), "vectors")

    largest = vectors.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    depth = min(max(1, math.ceil(math.log(max(largest, 1) / CELL, FEWER))), 5)
    cell = ["label", "dim", "number", "cell"]
    seen = vectors.select("label", "dim", "part").mapInArrow(_visits(cosine, depth, False), "label string, dim int, number int, cell long")
    heavy = store(seen.groupBy(*cell).count().where(F.col("count") > CELL).select(*cell, F.ceil(F.col("count") / CELL).cast("int").alias("chunks")), "cells")

    visits = vectors.select("label", "dim", "node", "copies", "part").mapInArrow(_visits(cosine, depth, True), "label string, dim int, number int, cell long, home boolean, node long, copies long, part binary")
    members = visits.join(heavy, cell, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1))).withColumn("chunk", F.pmod(F.xxhash64("node", "number"), "chunks").cast("int"))
    every = F.sequence(F.lit(0), F.col("chunks") - 1)
    pair = lambda i, j: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"))
    as_other, as_home = F.transform(every, lambda t: pair(t, F.col("chunk"))), F.transform(every, lambda t: pair(F.col("chunk"), t))
    tiles = members.withColumn("tile", F.explode(F.when(F.col("home"), F.array_union(as_other, as_home)).otherwise(as_other)))
    tiles = tiles.select(*cell, "tile.i", "tile.j", "chunk", "home", "node", "copies", "part")
    found = store(tiles.groupBy(*cell, "i", "j").applyInArrow(_tile(cosine), FOUND), "links")

    side = lambda node, exact, n: vectors.select(F.col("node").alias(node), F.col("exact").alias(exact), F.col("copies").alias(n), "dim")
    unclear = found.where(F.col("kind") == OPEN).select("a", "b").join(side("a", "exact", "na"), "a").join(side("b", "exact2", "nb").drop("dim"), "b")
    confirmed = store(unclear.mapInArrow(_verify(cosine), "a long, b long, na long, nb long"), "confirmed")
    counted = found.where(F.col("kind") == COUNT).select("a", "n")
    counted = counted.unionAll(confirmed.select("a", "nb")).unionAll(confirmed.select("b", "na"))
    links = counted.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    edges = found.where(F.col("kind") == EDGE).select("a", "b").unionAll(confirmed.select("a", "b"))
    joined = components(edges).join(vectors.select("node", "least"), "node")
    ids = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    named = joined.join(ids, "component").select("node", "component_id")
    result = vectors.select(*keys, "node", "least", "copies").join(links, "node", "left").join(named, "node", "left")
    # a component without any id has none; the others have at least the least id of their own copies
    result = result.select(*keys, (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component_id", "least").alias("component_id"), F.lit(True).alias("known"))
    done = keyed.select("vec_id", F.col("label"), F.when(F.col("label").isNotNull(), F.col("h1")).otherwise(F.xxhash64("vec_id")).alias("h1"), "h2").join(result, keys, "left")
    component = F.when(F.col("known"), F.col("component_id")).otherwise(F.col("vec_id"))
    return done.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(read(spark, sf_dir, "embeddings"))
