"""Ranked lexical search of many items in all documents, by a search of two trees at once.

Documents are reduced once to the terms that some item holds, with their counts, and written; the
statistics of terms come from that table. A task then searches its documents, ``BATCH`` at a
time. Documents that share their most telling term lie next to each other; ``FAN`` of them are a node, and so
on up to a root. A node holds for each term the greatest value among its documents. Items form a tree
alike, whose nodes hold the greatest weights. The product of the two bounds every score below a pair of
nodes: where it is below the weakest ``TOP``-th score among the node's items so far, the whole batch
of pairs is passed over; otherwise both nodes are opened. What is left are items and small groups
of documents, which are scored in 64-bit integers. Bounds carry a margin for rounding, so nothing
that could rank is lost.

Each task keeps the best documents of each item, in a table of fixed size, and these few are ranked
in two steps, by groups of tasks and then by item. Items come in blocks of about ``BLOCK_BYTES``; the
terms of one block travel to the tasks, and each block is one pass. Words are told apart by 64 bits.

Results for odd input: null texts of documents or items have no terms, nor do those without letters and digits;
very long texts are read in pieces cut between terms; documents without an id come after all others of
equal score, repeated rows are documents of their own, repeated items are ranked each; equal scores
go by id; an empty table of either kind gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartulary.llm.arrays import SLICE_BYTES, U64, find_words, hash_spans, ragged, rows_of, slices, text_bytes
from cartulary.llm.shared import NO_ID, doc_id, partitions, read, store, text_size

TOP = 20
BLOCK_BYTES = 16_000_000
BATCH, FAN = 4_096, 8
# Relative margin of a bound over the rounding of its sum.
MARGIN = 1 + 1e-9

IN_TERM = np.zeros(256, bool)
IN_TERM[0x80:] = IN_TERM[0x30:0x3A] = IN_TERM[0x41:0x5B] = IN_TERM[0x61:0x7B] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def pieces(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Bytes, offsets and number of the first document; a text beyond ``most`` comes in pieces that end between terms."""
    raw, offsets = text_bytes(column)
    if len(offsets) != 2 or len(raw) <= most:
        yield raw, offsets, 0
        return
    start = 0
    while start < len(raw):
        stop = start + most
        while stop < len(raw) and IN_TERM[raw[stop]]:
            gap = np.flatnonzero(~IN_TERM[raw[stop : stop + most]])
            stop += int(gap[0]) if len(gap) else most
        part = raw[start:stop]
        yield part, np.array([0, len(part)]), 0
        start = stop


def hashed_terms(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms, document by document, and the number of terms before each document."""
    raw = LOWER[raw]
    starts, ends, before = find_words(raw, offsets, IN_TERM)
    return hash_spans(raw, starts, ends), before


def _total(keys: tuple[np.ndarray, ...], values: np.ndarray, how: np.ufunc) -> tuple[np.ndarray, ...]:
    """Values of equal keys combined; the result is in the order of the keys, the first before the second."""
    if not len(values):
        return (*keys, values)
    order = np.lexsort(keys[::-1])
    keys, values = tuple(k[order] for k in keys), values[order]
    new = np.concatenate(([True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys])))
    lead = np.flatnonzero(new)
    return (*(k[lead] for k in keys), how.reduceat(values, lead))


COUNTED = "doc long, n long, terms binary, counts binary"


def _count(vocabulary: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per document its number of terms, and number and count of those in the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes = np.zeros(batch.num_rows, np.int64)
            found = (np.zeros(0, np.int64),) * 3
            for raw, offsets, _ in pieces(batch.column("text")):
                hashes, before = hashed_terms(raw, offsets)
                sizes += np.diff(before)
                at = np.minimum(np.searchsorted(vocabulary, hashes), max(len(vocabulary) - 1, 0))
                hit = vocabulary[at] == hashes if len(vocabulary) else np.zeros(len(hashes), bool)
                owner = rows_of(np.diff(before))[hit]
                keys = tuple(np.concatenate(x) for x in zip(found[:2], (owner, at[hit]), strict=True))
                found = _total(keys, np.concatenate((found[2], np.ones(len(owner), np.int64))), np.add)
            owner, term, count = found
            cuts = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            packed = [
                pa.array([x[a:b].astype("<i4").tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())
                for x in (term, count)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(sizes), *packed], ["doc", "n", "terms", "counts"])

    return run


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    term, df = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        more = np.frombuffer(b"".join(batch.column("terms").to_pylist()), "<i4").astype(np.int64)
        term, df = _total((np.concatenate((term, more)),), np.concatenate((df, np.ones(len(more), np.int64))), np.add)
    yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(df)], ["term", "df"])


class Level(NamedTuple):
    """Nodes of one level of a tree and their coordinates; by node or, as an index, by term."""

    size: int
    node: np.ndarray
    term: np.ndarray
    value: np.ndarray


def grow(size: int, node: np.ndarray, term: np.ndarray, value: np.ndarray, fan: int) -> list[Level]:
    """A level for each power of ``fan``, from the leaves to one root, with coordinate maxima; by node."""
    levels = [Level(size, node, term, value)]
    while levels[-1].size > 1:
        below = levels[-1]
        node, term, value = _total((below.node // fan, below.term), below.value, np.maximum)
        levels.append(Level(-(-below.size // fan), node, term, value))
    return levels


class Items:
    """The tree over the items of a block: of each node its terms, their greatest weights and its range of items."""

    def __init__(self, ids: list, item: np.ndarray, term: np.ndarray, weight: np.ndarray, df: np.ndarray, fan: int = FAN):
        self.fan = fan
        order = np.arange(len(ids))
        if len(item):
            # items of one language share their most frequent words
            by = np.lexsort((df[term], item))
            last = np.flatnonzero(np.append(item[by][1:] != item[by][:-1], True))
            common = np.full(len(ids), -1)
            common[item[by][last]] = term[by][last]
            order = np.lexsort((np.arange(len(ids)), common))
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        self.ids = [ids[i] for i in order]
        node, term, weight = _total((place[item], term), weight, np.maximum)
        self.levels = []
        for depth, level in enumerate(grow(len(ids), node, term, weight, fan)):
            cuts = np.searchsorted(level.node, np.arange(level.size + 1))
            self.levels.append([
                (level.term[a:b], level.value[a:b], slice(i * fan**depth, min((i + 1) * fan**depth, len(ids))))
                for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
            ])


class Best:
    """The ``TOP`` best documents of each item so far; score 0 stands for none."""

    def __init__(self, n_items: int):
        self.score = np.zeros((n_items, TOP), np.int64)
        self.doc = np.full((n_items, TOP), NO_ID)

    def least(self, items: slice) -> int:
        """What a document must reach to change anything for some of these items."""
        return max(int(self.score[items, -1].min()), 1)

    def add(self, item: int, docs: np.ndarray, scores: np.ndarray) -> None:
        weakest, at = self.score[item, -1], self.doc[item, -1]
        better = (scores > weakest) | ((scores == weakest) & (scores > 0) & (docs < at))
        if better.any():
            scores = np.concatenate((self.score[item], scores[better]))
            docs = np.concatenate((self.doc[item], docs[better]))
            order = np.lexsort((docs, -scores))[:TOP]
            self.score[item], self.doc[item] = scores[order], docs[order]


class Documents:
    """The tree over a batch of documents: leaves by document, upper levels as an index by term."""

    def __init__(self, ids: np.ndarray, node: np.ndarray, term: np.ndarray, value: np.ndarray, weight: np.ndarray, fan: int = FAN):
        self.fan = fan
        order = np.arange(len(ids))
        if len(node):
            by = np.lexsort((value * weight[term], node))
            last = np.flatnonzero(np.append(node[by][1:] != node[by][:-1], True))
            telling = np.full(len(ids), -1)
            telling[node[by][last]] = term[by][last]
            order = np.lexsort((np.arange(len(ids)), telling))
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        self.ids = ids[order]
        node, term, value = _total((place[node], term), value, np.maximum)
        levels = grow(len(ids), node, term, value, fan)
        self.starts = np.searchsorted(node, np.arange(len(ids) + 1))
        self.term, self.value = term, value
        self.levels = [None]
        for level in levels[1:] or levels:
            by = np.argsort(level.term, kind="stable")
            terms, first = np.unique(level.term[by], return_index=True)
            self.levels.append((level.size, terms, np.append(first, len(by)), level.node[by], level.value[by]))

    def below(self, nodes: np.ndarray) -> np.ndarray:
        return (nodes[:, None] * self.fan + np.arange(self.fan)).ravel()

    def bounds(self, level: int, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What no score of an item with at most these weights exceeds, for each node."""
        size, known, first, node, value = self.levels[level]
        at = np.searchsorted(known, terms)
        has = at < len(known)
        has[has] = known[at[has]] == terms[has]
        at = at[has]
        lengths = first[at + 1] - first[at]
        which = ragged(first[at], lengths)
        products = np.repeat(weights[has], lengths).astype(np.float64) * value[which]
        return np.bincount(node[which], products, minlength=size) * MARGIN

    def scores(self, docs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        lengths = self.starts[docs + 1] - self.starts[docs]
        which = ragged(self.starts[docs], lengths)
        sums = np.concatenate(([0], np.cumsum(weight[self.term[which]] * self.value[which])))
        ends = np.cumsum(lengths)
        return sums[ends] - sums[ends - lengths]


def search(items: Items, documents: Documents, best: Best, weight: np.ndarray) -> int:
    """Rank the documents for all items; returns how many documents were scored, of items times documents.

    ``weight`` is a scratch array of zeros, one for each term.
    """
    scored = 0

    def visit(depth: int, node: int, level: int, alive: np.ndarray) -> None:
        nonlocal scored
        terms, weights, covered = items.levels[depth][node]
        alive = alive[documents.bounds(level, terms, weights)[alive] >= best.least(covered)]
        if not len(alive):
            return
        if depth == 0 and level == 1:
            docs = documents.below(alive)
            docs = docs[docs < len(documents.ids)]
            weight[terms] = weights
            best.add(node, documents.ids[docs], documents.scores(docs, weight))
            weight[terms] = 0
            scored += len(docs)
            return
        if level > 1:
            level -= 1
            alive = documents.below(alive)
            alive = alive[alive < documents.levels[level][0]]
        below = range(node * items.fan, min((node + 1) * items.fan, len(items.levels[depth - 1]))) if depth else (node,)
        for child in below:
            visit(max(depth - 1, 0), child, level, alive)

    if items.ids and len(documents.ids):
        visit(len(items.levels) - 1, 0, len(documents.levels) - 1, np.zeros(1, np.int64))
    return scored


def values(counts: np.ndarray, owner: np.ndarray, sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term adds to the score of its document, for each unit of weight."""
    m = np.array([75 + 25 * int(n) * n_docs // n_terms for n in sizes], np.int64)
    return 1_000_000_000 * counts // (1_000 * counts + 12 * m[owner])


RANKED = "part int, item long, item_id long, doc long, score long"


def _rank(items: Items, weight: np.ndarray, n_docs: int, n_terms: int, groups: int, batch_rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, scratch = Best(len(items.ids)), np.zeros(len(weight), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, batch_rows):
                part = batch.slice(start, batch_rows)
                terms, counts = (np.frombuffer(b"".join(part.column(c).to_pylist()), "<i4").astype(np.int64) for c in ("terms", "counts"))
                owner = rows_of(np.array([len(x) // 4 for x in part.column("terms").to_pylist()], np.int64))
                worth = values(counts, owner, part.column("n").to_numpy(), n_docs, n_terms)
                search(items, Documents(part.column("doc").to_numpy(), owner, terms, worth, weight, items.fan), best, scratch)
        item, place = np.nonzero(best.score)
        columns = [
            pa.array(np.full(len(item), TaskContext.get().partitionId() % groups, np.int32)), pa.array(item),
            pa.array([items.ids[i] for i in item], pa.int64()), pa.array(best.doc[item, place]), pa.array(best.score[item, place]),
        ]
        yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in RANKED.split(", ")])

    return run


def _vocabulary(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes of the terms of all items, and of each item the numbers of its terms and their counts."""
    column = pa.array(texts, pa.large_string())
    hashes, before = hashed_terms(*text_bytes(column))
    vocabulary, number = np.unique(hashes, return_inverse=True)
    item, term, count = _total((rows_of(np.diff(before)), number), np.ones(len(number), np.int64), np.add)
    return vocabulary.astype(U64), item, term, count


def lexical_search(docs: DataFrame, items: DataFrame, batch: int = BATCH, fan: int = FAN) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``TOP`` best documents of each item.

    ``docs`` has ``doc_id, text``, ``items`` has ``item_id, text``. Trees are built of ``batch``
    documents, with ``fan`` children a node.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    blocks = max(1, math.ceil(text_size(asked) / BLOCK_BYTES))
    found = None
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect() if blocks > 1 else asked.collect()
        ranked = _search_block(spark, texts, [r.item_id for r in rows], [r.text for r in rows], batch, fan)
        found = ranked if found is None else found.unionByName(ranked)
    return found


def _search_block(spark: SparkSession, texts: DataFrame, ids: list, item_texts: list[str], batch: int, fan: int) -> DataFrame:
    vocabulary, item, term, count = _vocabulary(item_texts)
    counted = store(texts.mapInArrow(_count(vocabulary), COUNTED), "terms")
    n_docs, n_terms = counted.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    seen = counted.select("terms").mapInArrow(_frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(len(vocabulary), np.int64)
    df[seen.column("term").to_numpy()] = seen.column("df").to_numpy()
    weight = np.array([math.floor(1_000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    tree = Items(ids, item, term, count * weight[term], df, fan)
    groups = max(1, math.isqrt(partitions(spark)))
    best = counted.mapInArrow(_rank(tree, weight, n_docs, max(n_terms, 1), groups, batch), RANKED)
    order = (F.col("score").desc(), F.col("doc"))
    for by in (["part", "item"], ["item"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= TOP)
    return best.select("item_id", F.col("rank").cast("int").alias("rank"), doc_id(), "score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
