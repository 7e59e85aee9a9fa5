"""Benchmark decontamination by SimHash over item-sized windows.

Each benchmark item has a fingerprint: the signs of the sum of its shingles' hash bits. A
window of a document with as many words as the item is fingerprinted the same way. A
multi-index over blocks of fingerprint bits returns, without exception, all items within
``RADIUS`` bits of a window: of two fingerprints within it, some block differs in at most
``RADIUS // BLOCKS`` bits, and the index lists each item under all such neighbours of its
blocks. Candidates are then verified by exact weighted Jaccard similarity of their five-word
shingles. At similarity 0.8 the expected distance is 10 bits with a deviation of 3.

Windows that share too few shingles with all items together cannot reach the similarity
and are not fingerprinted. Letters A-Z are lower-cased first. Items are dealt to blocks of
about ``ITEMS`` items; one block at a time is sent to the executors, so the broadcast is
bounded for a benchmark of any size, and every block is compared with every document.

Results for odd input: items without words (null, empty, blank) match nothing; an item of one
to four words is one shingle; a document shorter than an item is one window for it; null
text has no words; null ids are carried as they are; repeated rows give equal results; other
columns of the input are not read by ``find_leaks`` and pass through ``decontaminate``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.llm.arrays import U64, find_words, grams, hash_spans, ragged, slices, text_bytes
from cartulary.llm.minhash_dedup import similarity
from cartulary.llm.shared import read

SHINGLE = 5
SIMILARITY = 0.8
RADIUS, BLOCKS = 19, 4
ITEMS = 500
_BITS = 64 // BLOCKS
_TABLE_BITS = 22


def _lower(raw: np.ndarray) -> np.ndarray:
    return np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw, offsets = text_bytes(column)
    raw = _lower(raw)
    starts, ends, words = find_words(raw, offsets)
    return hash_spans(raw, starts, ends), words


def neighbours(radius: int = RADIUS // BLOCKS, bits: int = _BITS) -> np.ndarray:
    """All values of ``bits`` bits with at most ``radius`` bits set."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(bits), r)], np.int64)


def _blocks(prints: np.ndarray) -> np.ndarray:
    return np.stack([(prints >> U64(_BITS * b)) & U64((1 << _BITS) - 1) for b in range(BLOCKS)], 1).astype(np.int64)


def fingerprints(shingles: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """SimHash of the runs ``shingles[start : start + length]``."""
    used = np.unique(ragged(starts, lengths))
    bits = np.unpackbits(shingles[used].view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) * 2 - 1
    sums = np.concatenate((np.zeros((1, 64), np.int32), np.cumsum(bits, 0, dtype=np.int32)))
    at = np.searchsorted(used, starts)
    return np.packbits(sums[at + lengths] - sums[at] > 0, axis=1).view(np.uint64).ravel()


class Items(NamedTuple):
    """A block of the benchmark, indexed. Sizes are in words, prints by item."""

    ids: list
    size: np.ndarray
    bags: list
    prints: np.ndarray
    keys: np.ndarray
    owners: np.ndarray
    known: np.ndarray
    table: np.ndarray


@lru_cache(maxsize=2)  # of a worker, whose tasks mostly read the same block
def index_items(rows: tuple[tuple, ...]) -> Items:
    values, words = _words(pa.array([t for _, t in rows], pa.string()))
    size = np.diff(words)
    full = [i for i in range(len(rows)) if size[i]]
    ids, bags, prints = [rows[i][0] for i in full], [], []
    for i in full:
        part = values[words[i] : words[i + 1]]
        shingles = grams(part, min(SHINGLE, len(part)))
        bags.append(np.unique(shingles, return_counts=True))
        prints.append(fingerprints(shingles, np.zeros(1, np.int64), np.array([len(shingles)]))[0])
    size, prints = size[full], np.array(prints, U64)
    if not full:
        none = np.zeros(0, np.int64)
        return Items(ids, none, bags, prints, none, none, np.zeros(0, U64), np.zeros(1, bool))
    near = neighbours()
    keys = (((size[:, None] * BLOCKS + np.arange(BLOCKS)) << _BITS)[:, :, None] | (_blocks(prints)[:, :, None] ^ near)).reshape(-1)
    order = np.argsort(keys, kind="stable")
    owners = np.repeat(np.arange(len(full)), BLOCKS * len(near))[order]
    known = np.unique(np.concatenate([b[0] for b, n in zip(bags, size, strict=True) if n >= SHINGLE] or [np.zeros(0, U64)]))
    table = np.zeros(1 << _TABLE_BITS, bool)
    table[(known >> U64(64 - _TABLE_BITS)).astype(np.int64)] = True
    return Items(ids, size, bags, prints, keys[order], owners, known, table)


def _candidates(items: Items, size: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows and items of ``size`` words whose fingerprints are within the radius."""
    keys = (((size * BLOCKS + np.arange(BLOCKS)) << _BITS) | _blocks(prints)).reshape(-1)
    low, high = np.searchsorted(items.keys, keys, "left"), np.searchsorted(items.keys, keys, "right")
    window = np.repeat(np.repeat(np.arange(len(prints)), BLOCKS), high - low)
    item = items.owners[ragged(low, high - low)]
    pairs = np.unique(window * len(items.ids) + item)
    window, item = pairs // len(items.ids), pairs % len(items.ids)
    near = np.bitwise_count(prints[window] ^ items.prints[item]) <= RADIUS
    return window[near], item[near]


def _windows(hits: np.ndarray, words: np.ndarray, size: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First words and widths of the windows for items of ``size`` words that hold ``least`` of the hits.

    ``hits`` are positions of shingles that some item has, in order. A shorter document is one window.
    """
    if len(hits) < least:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    head, tail = hits[: len(hits) - least + 1], hits[least - 1 :]
    doc = np.searchsorted(words, head, "right") - 1
    fits = (tail < words[doc + 1]) & (tail - head <= size - SHINGLE)
    head, tail, doc = head[fits], tail[fits], doc[fits]
    begin, end = words[doc], words[doc + 1]
    short = end - begin < size
    low = np.where(short, begin, np.maximum(tail - (size - SHINGLE), begin))
    high = np.where(short, begin, np.minimum(head, end - size))
    starts = np.unique(ragged(low, np.maximum(high - low + 1, 0)))
    doc = np.searchsorted(words, starts, "right") - 1
    return starts, np.minimum(size, words[doc + 1] - words[doc])


def scan(items: Items, column: pa.Array) -> dict[tuple[int, int], tuple[float, int, int]]:
    """Best window of each pair of text (by place) and item that are similar: similarity, first word, words."""
    values, words = _words(column)
    found: dict[tuple[int, int], tuple[float, int, int]] = {}
    if not len(values) or not len(items.ids):
        return found

    def verify(starts: np.ndarray, widths: np.ndarray, size: int, shingles: np.ndarray, gram: int) -> None:
        rows = np.searchsorted(words, starts, "right") - 1
        for window, item in zip(*_candidates(items, size, fingerprints(shingles, starts, widths - gram + 1)), strict=True):
            start, width = int(starts[window]), int(widths[window])
            bag = np.unique(shingles[start : start + width - gram + 1], return_counts=True)
            score, row = similarity(bag, items.bags[item]), int(rows[window])
            best = found.get((row, int(item)))
            if score >= SIMILARITY and (best is None or score > best[0]):
                found[row, int(item)] = (score, start - int(words[row]), width)

    shingles = grams(values, SHINGLE)
    room = np.repeat(words[1:], np.diff(words)) - np.arange(len(values))
    hits = np.flatnonzero(items.table[(shingles >> U64(64 - _TABLE_BITS)).astype(np.int64)] & (room[: len(shingles)] >= SHINGLE))
    hits = hits[np.isin(shingles[hits], items.known)]
    for size in np.unique(items.size):
        if size < SHINGLE:
            part = grams(values, int(size))
            starts = np.flatnonzero(room[: len(part)] >= size)
            starts = starts[np.isin(part[starts], np.concatenate([b[0] for b, n in zip(items.bags, items.size, strict=True) if n == size]))]
            widths, gram = np.full(len(starts), size), int(size)
        else:
            part, gram = shingles, SHINGLE
            starts, widths = _windows(hits, words, int(size), max(1, int(np.ceil(SIMILARITY * (size - SHINGLE + 1) - 1e-9))))
        if len(starts):
            verify(starts, widths, int(size), part, gram)
    return found


def item_blocks(benchmark: DataFrame) -> Iterator[tuple[tuple, ...]]:
    """The items with words, dealt to blocks of about ``ITEMS``."""
    items = benchmark.select("item_id", "text").where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    count = -(-items.count() // ITEMS)
    for block in range(count):
        dealt = F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block
        yield tuple(tuple(r) for r in items.where(dealt).orderBy("item_id", "text").collect())


def _leaks(shared):
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("similarity", pa.float64()), ("start_word", pa.int64()), ("n_words", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = index_items(shared.value)
        for part in slices(batches):
            ids = part.column("doc_id")
            rows = [(ids[row].as_py(), items.ids[item], *best) for (row, item), best in sorted(scan(items, part.column("text")).items())]
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)

    return run


def _clean(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = index_items(shared.value)
        for part in slices(batches):
            leaky = {row for row, _ in scan(items, part.column("text"))}
            yield part.filter(pa.array([row not in leaky for row in range(part.num_rows)], pa.bool_()))

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, similarity, start_word, n_words``: the best window of each document and item that match."""
    spark, rows, found = docs.sparkSession, docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), None
    ddl = "doc_id long, item_id long, similarity double, start_word long, n_words long"
    for block in item_blocks(benchmark):
        part = rows.mapInArrow(_leaks(spark.sparkContext.broadcast(block)), ddl)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], ddl) if found is None else found


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    for block in item_blocks(benchmark):
        docs = docs.mapInArrow(_clean(docs.sparkSession.sparkContext.broadcast(block)), docs.schema)
    return docs


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
