"""Line dedup with two Bloom filters.

A first pass over the texts fills a filter of the line keys seen once and one of those seen
twice, in parts that merge: what two parts have both seen has been seen twice. The filters have
a fixed number of bits, so the second may be broadcast at any size of the corpus. Only lines it
suspects are shuffled, where their keys are compared exactly, the documents of each are counted
and the one that keeps its lines is chosen. With more lines than the filter is made for, more
lines are shuffled and the result stays the same.

A key is the line without blanks at both ends and with A-Z lower-cased. Keys of at least
``min_chars`` code points found in at least ``min_docs`` documents lose their lines except in
the largest document id that holds them, where all stay.

Results for odd input: null or empty text is one empty line; a null id comes after all ids, and
rows without an id count as one document, as do rows of one id; of such rows each is cut by its
own lines; other columns of the input are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.llm.arrays import U64, mix
from cartulary.llm.shared import doc_id, keyed, partitions, read, store

MIN_CHARS, MIN_DOCS = 40, 5
FILTER_BITS = 26
HASHES = 3
SEGMENT_BITS = 20
_BLANKS = " \t\n\v\f\r"
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_ASCII_UPPER = re.compile("[A-Z]")


def line_key(line: str) -> str:
    key = line.strip(_BLANKS)
    return key.translate(_LOWER) if _ASCII_UPPER.search(key) else key


def long_keys(text: str | None, min_chars: int) -> Iterator[tuple[int, str]]:
    """Line numbers and keys of the lines that are long enough to be judged."""
    for number, line in enumerate((text or "").split("\n")):
        if len(line) >= min_chars:
            key = line_key(line)
            if len(key) >= min_chars:
                yield number, key


def _hash(key: str) -> int:
    return xxhash.xxh3_64_intdigest(key)


def bit_places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """One row of bit numbers for each hash."""
    step = mix(hashes) | U64(1)
    return np.stack([mix(hashes + U64(i) * step) >> U64(64 - bits) for i in range(HASHES)], 1)


def _fill(min_chars: int, bits: int):
    schema = pa.schema([("segment", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(hashes: np.ndarray) -> pa.RecordBatch:
            seen, counts = np.unique(hashes, return_counts=True)
            rows = []
            once, twice = np.unique(bit_places(seen, bits)), np.unique(bit_places(seen[counts > 1], bits))
            edges = np.arange(0, (1 << bits) + 1, 1 << min(bits, SEGMENT_BITS)).astype(U64)
            a, b = np.searchsorted(once, edges), np.searchsorted(twice, edges)
            for s in range(len(edges) - 1):
                if a[s] < a[s + 1]:
                    rows.append({"segment": s, "once": (once[a[s] : a[s + 1]] - edges[s]).astype(np.uint32).tobytes(), "twice": (twice[b[s] : b[s + 1]] - edges[s]).astype(np.uint32).tobytes()})
            return pa.RecordBatch.from_pylist(rows, schema)

        held: list[int] = []
        for batch in batches:
            for text in batch.column("text").to_pylist():
                held.extend({_hash(key) for _, key in long_keys(text, min_chars)})
            if len(held) > 2_000_000:
                yield flush(np.array(held, U64))
                held = []
        if held:
            yield flush(np.array(held, U64))

    return run


def _merge_segments(bits: int):
    size = 1 << min(bits, SEGMENT_BITS)
    schema = pa.schema([("segment", pa.int32()), ("twice", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, once, twice = None, np.zeros(size, bool), np.zeros(size, bool)

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"segment": current, "twice": np.packbits(twice).tobytes()}], schema)

        for batch in batches:
            for row in batch.to_pylist():
                if row["segment"] != current:
                    if current is not None:
                        yield done()
                    current, once, twice = row["segment"], np.zeros(size, bool), np.zeros(size, bool)
                part = np.frombuffer(row["once"], np.uint32)
                twice[part[once[part]]] = True
                twice[np.frombuffer(row["twice"], np.uint32)] = True
                once[part] = True
        if current is not None:
            yield done()

    return run


def twice_seen(docs: DataFrame, min_chars: int, bits: int) -> np.ndarray:
    """The filter of keys seen twice, of ``2**bits`` bits."""
    segments = (
        docs.select("text")
        .mapInArrow(_fill(min_chars, bits), "segment int, once binary, twice binary")
        .repartition(partitions(docs.sparkSession), "segment")
        .sortWithinPartitions("segment")
        .mapInArrow(_merge_segments(bits), "segment int, twice binary")
    )
    size = 1 << min(bits, SEGMENT_BITS)
    out = np.zeros(((1 << bits) // size, (size + 7) // 8), np.uint8)
    for row in segments.collect():  # 2**bits bits together
        out[row.segment] = np.frombuffer(row.twice, np.uint8)
    return out


def _suspects(min_chars: int, bits: int, shared):
    schema = pa.schema([("doc", pa.int64()), ("salt", pa.binary()), ("line", pa.int32()), ("key", pa.string())])
    size = 1 << min(bits, SEGMENT_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            rows, lines, keys = [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                for number, key in long_keys(text, min_chars):
                    rows.append(row)
                    lines.append(number)
                    keys.append(key)
            if not keys:
                continue
            places = bit_places(np.array([_hash(k) for k in keys], U64), bits).astype(np.int64)
            byte = (places // size) * ((size + 7) // 8) + (places % size) // 8
            hit = np.flatnonzero(((held[byte] >> (7 - places % 8)) & 1).all(1))
            rows = np.array(rows)[hit]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(pa.array(rows)), batch.column("salt").take(pa.array(rows)), pa.array(np.array(lines, np.int32)[hit]), pa.array([keys[i] for i in hit], pa.string())],
                schema=schema,
            )

    return run


def dropped_lines(docs: DataFrame, min_chars: int, min_docs: int, bits: int) -> DataFrame:
    """``doc, salt, lines``: the numbers of the lines that each document loses."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(twice_seen(docs, min_chars, bits).tobytes())
    suspects = store(docs.mapInArrow(_suspects(min_chars, bits, shared), "doc long, salt binary, line int, key string"), "suspects")
    holders = suspects.select("key", "doc").distinct()
    frequent = holders.groupBy("key").agg(F.count("*").alias("n"), F.max("doc").alias("keeper")).where(F.col("n") >= min_docs)
    lost = suspects.join(frequent.select("key", "keeper"), "key").where("doc <> keeper")
    return lost.groupBy("doc", "salt").agg(F.collect_set("line").alias("lines"))


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, bits: int = FILTER_BITS) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept`` for each row of ``docs`` (``doc_id, text``)."""
    rows = keyed(docs)
    return cut(rows, rows, min_chars, min_docs, bits).select(doc_id(), *counts(), kept().alias("kept"))


def cut(keyed_docs: DataFrame, carried: DataFrame, min_chars: int, min_docs: int, bits: int) -> DataFrame:
    """``carried`` (with ``doc, salt, text``) and the numbers of its ``lines`` to drop, or null."""
    return carried.join(dropped_lines(keyed_docs, min_chars, min_docs, bits), ["doc", "salt"], "left")


def counts() -> list[Column]:
    return [
        (F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"))) + 1).cast("long").alias("n_lines"),
        F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_dropped"),
    ]


def kept() -> Column:
    """The text without its dropped lines."""
    lines = F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains("lines", i))
    return F.when(F.col("lines").isNull(), F.col("text")).otherwise(F.array_join(lines, "\n"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
