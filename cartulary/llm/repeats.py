"""Repeats of fixed length between documents, found through content-chosen anchors.

Two exchanges of compact rows, whatever the documents hold:

1. Every anchor sends its fingerprint and that of its context (all windows that picked it) to
   a bucket. Occurrences whose context also stands in an earlier document are repeats in
   full. An anchor that several documents share in different contexts asks for a closer
   look, once for each different context.
2. These contexts themselves go to buckets, where a matcher (Lempel-Ziv factors, suffix
   arrays) finds out which of their windows start in an earlier document.

Thousands of copies of a document thus cost a fingerprint each, and a passage that a third of
all documents hold is spread over the buckets of its many anchors. A bucket is read as a
stream of blocks and holds about ``BUCKET_BYTES`` of text at any size of the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartulary.llm.anchors import pick_anchors
from cartulary.llm.arrays import U64, mix, powers, ragged, slices, text_bytes
from cartulary.llm.shared import SALT_BYTES, partitions, shuffles_removed, store, text_size

BUCKET_BYTES = 8_000_000
EMIT = 1_000_000
_LOW48 = U64((1 << 48) - 1)
# Salts as numpy compares and sorts them; a single element of it would lose its trailing zeros, a slice does not.
_SALT = f"S{SALT_BYTES}"
# Sequences of a slice: values to compare, and the document offsets among them.
Sequences = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def pack(values: np.ndarray, width: int) -> bytes:
    """The ``width`` low bytes of each value, one plane after another: equal high bytes compress well."""
    return np.ascontiguousarray(values.astype(np.uint64).view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unpack(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view(np.uint64).ravel()


def salts_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), _SALT)


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """Rows of one bucket after another; the input is sorted by bucket."""
    bucket, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != bucket:
                if rows:
                    yield bucket, rows
                bucket, rows = row["bucket"], []
            rows.append(row)
    if rows:
        yield bucket, rows


def grouped(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of runs of equal values."""
    starts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)
    return starts, np.diff(np.append(starts, len(values)))


def bucket_of(prints: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each fingerprint, out of any number of them, and 48 bits to tell those of a bucket apart."""
    scrambled = mix(prints)
    return scrambled % U64(buckets), scrambled // U64(buckets) & _LOW48


def _emit_anchors(sequences: Sequences, window: int, gram: int, buckets: int):
    def emit(held: list[tuple]) -> Iterator[dict]:
        docs, salts = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
        base = np.cumsum([0] + [len(h[0]) for h in held])
        refs = np.concatenate([h[2] + b for h, b in zip(held, base[:-1], strict=True)])
        first, run, prints, contexts = (np.concatenate([h[i] for h in held]) for i in range(3, 7))
        # bucket and the rest make up the whole fingerprint, or 48 bits and those of the bucket while there are few
        bucket, prints = bucket_of(prints, buckets)
        order = np.argsort(bucket, kind="stable")
        starts, sizes = grouped(bucket[order])
        for start, size in zip(starts, sizes, strict=True):
            part = order[start : start + size]
            used, local = np.unique(refs[part], return_inverse=True)
            yield {
                "bucket": int(bucket[part[0]]),
                "docs": pack(docs[used], 8),
                "salts": salts[used].tobytes(),
                "refs": pack(local, 4),
                "first": pack(first[part], 6),
                "run": pack(run[part], 3),
                "prints": pack(prints[part], 6),
                "contexts": pack(contexts[part], 6),
            }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for part in slices(batches):
            values, offsets = sequences(*text_bytes(part.column("text")))
            found = pick_anchors(values, offsets, window, gram)
            if not len(found.at):
                continue
            up, down = powers(len(values) + 1)
            sums = np.zeros(len(values) + 1, U64)
            np.cumsum(values * up[: len(values)], out=sums[1:])
            ends = found.last + window
            context = (sums[ends] - sums[found.first]) * down[found.first]
            context = (context ^ (context >> U64(29))) * U64(0xBF58476D1CE4E5B9) + (ends - found.first).astype(U64)
            context = (context ^ (context >> U64(32))) & _LOW48
            refs = np.searchsorted(offsets, found.at, "right") - 1
            ids = part.column("doc").to_numpy(zero_copy_only=False)
            salts = salts_of(part.column("salt"))
            held.append((ids, salts, refs, found.first - offsets[refs], found.last - found.first, found.print, context))
            count += len(refs)
            if count >= EMIT:
                yield from _table(emit(held), ANCHORS)
                held, count = [], 0
        if held:
            yield from _table(emit(held), ANCHORS)

    return run


ANCHORS = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in ("docs", "salts", "refs", "first", "run", "prints", "contexts"))])
ANCHORS_DDL = "bucket int, docs binary, salts binary, refs binary, first binary, run binary, prints binary, contexts binary"
REPLIES = pa.schema([("doc", pa.int64()), ("salt", pa.binary()), ("known", pa.binary()), ("asked", pa.binary())])
REPLIES_DDL = "doc long, salt binary, known binary, asked binary"
SPANS = pa.schema([("doc", pa.int64()), ("salt", pa.binary()), ("known", pa.binary())])
SPANS_DDL = "doc long, salt binary, known binary"


def _table(rows: Iterator[dict], schema: pa.Schema, most: int = 2000) -> Iterator[pa.RecordBatch]:
    part = []
    for row in rows:
        part.append(row)
        if len(part) == most:
            yield pa.RecordBatch.from_pylist(part, schema)
            part = []
    if part:
        yield pa.RecordBatch.from_pylist(part, schema)


def per_document(docs: np.ndarray, salts: np.ndarray, keep: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """For each document among the kept entries: id, salt, and its entries of the columns as int64 bytes."""
    which = np.flatnonzero(keep)
    if not len(which):
        return
    which = which[np.lexsort((salts[which], docs[which]))]
    starts, sizes = grouped(docs[which])
    both = np.unique(np.concatenate((starts, grouped(salts[which])[0])))
    block = np.stack([c[which] for c in columns], 1).astype(np.int64)
    for start, stop in zip(both, np.append(both[1:], len(which)), strict=True):
        yield int(docs[which[start]]), salts[which[start : start + 1]].tobytes(), block[start:stop].tobytes()


def _find_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for bucket, rows in by_bucket(batches):
        docs = np.concatenate([unpack(r["docs"], 8)[unpack(r["refs"], 4).astype(np.int64)] for r in rows]).astype(np.int64)
        salts = np.concatenate([np.frombuffer(r["salts"], _SALT)[unpack(r["refs"], 4).astype(np.int64)] for r in rows])
        first = np.concatenate([unpack(r["first"], 6) for r in rows]).astype(np.int64)
        run = np.concatenate([unpack(r["run"], 3) for r in rows]).astype(np.int64)
        prints = np.concatenate([unpack(r["prints"], 6) for r in rows])
        contexts = np.concatenate([unpack(r["contexts"], 6) for r in rows])
        order = np.lexsort((docs, contexts, prints))
        docs, salts, first, run, prints, contexts = (x[order] for x in (docs, salts, first, run, prints, contexts))
        starts, sizes = grouped(prints)
        least, most = np.minimum.reduceat(docs, starts), np.maximum.reduceat(docs, starts)
        new = np.concatenate(([True], (prints[1:] != prints[:-1]) | (contexts[1:] != contexts[:-1])))
        firsts = np.flatnonzero(new)
        earliest = np.repeat(docs[firsts], np.diff(np.append(firsts, len(docs))))
        known = docs > earliest
        several = np.repeat((least != most) & (np.add.reduceat(new.astype(np.int64), starts) > 1), sizes)
        where = np.full(len(docs), bucket)
        replies = [{"doc": d, "salt": s, "known": b, "asked": None} for d, s, b in per_document(docs, salts, known, first, first + run)]
        replies += [{"doc": d, "salt": s, "known": None, "asked": b} for d, s, b in per_document(docs, salts, several & ~known, first, first + run, where)]
        yield from _table(iter(replies), REPLIES, 20_000)


CONTEXTS = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in ("docs", "salts", "first", "size", "values"))])
CONTEXTS_DDL = "bucket int, docs binary, salts binary, first binary, size binary, values binary"


def _emit_contexts(sequences: Sequences, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, most=16_000_000):
            values, offsets = sequences(*text_bytes(part.column("text")))
            asked = [np.concatenate([np.frombuffer(b, np.int64).reshape(-1, 3) for b in x]) for x in part.column("asked").to_pylist()]
            rows = np.repeat(np.arange(len(asked)), [len(a) for a in asked])
            every = np.concatenate(asked)
            docs = part.column("doc").to_numpy(zero_copy_only=False)[rows]
            salts = salts_of(part.column("salt"))[rows]
            order = np.argsort(every[:, 2], kind="stable")
            starts, sizes = grouped(every[order, 2])
            made = []
            for start, size in zip(starts, sizes, strict=True):
                which = order[start : start + size]
                first, length = every[which, 0], every[which, 1] - every[which, 0] + window
                made.append(
                    {
                        "bucket": int(every[which[0], 2]),
                        "docs": pack(docs[which], 8),
                        "salts": salts[which].tobytes(),
                        "first": pack(first, 6),
                        "size": pack(length, 4),
                        "values": values[ragged(first + offsets[rows[which]], length)].tobytes(),
                    }
                )
            yield from _table(iter(made), CONTEXTS)

    return run


# values, size of each context, documents -> for each window, whether it starts in an earlier document
Matcher = Callable[[np.ndarray, np.ndarray, np.ndarray, int], np.ndarray]


def _match_contexts(matcher: Matcher, window: int, dtype: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in by_bucket(batches):
            docs = np.concatenate([unpack(r["docs"], 8) for r in rows]).astype(np.int64)
            salts = np.concatenate([np.frombuffer(r["salts"], _SALT) for r in rows])
            first = np.concatenate([unpack(r["first"], 6) for r in rows]).astype(np.int64)
            size = np.concatenate([unpack(r["size"], 4) for r in rows]).astype(np.int64)
            values = np.concatenate([np.frombuffer(r["values"], dtype) for r in rows])
            order = np.lexsort((first, docs))
            at = np.cumsum(size) - size
            values, docs, salts, first, size = values[ragged(at[order], size[order])], docs[order], salts[order], first[order], size[order]
            hit = matcher(values, size, docs, window)
            counts = size - window + 1
            owner = np.repeat(np.arange(len(docs)), counts)
            place = np.repeat(first, counts) + ragged(np.zeros(len(docs), np.int64), counts)
            fresh = hit & ~np.concatenate(([False], hit[:-1] & (owner[1:] == owner[:-1])))
            final = hit & ~np.concatenate((hit[1:] & (owner[1:] == owner[:-1]), [False])) if len(hit) else hit
            begins, stops = np.flatnonzero(fresh), np.flatnonzero(final)
            who = owner[begins]
            found = per_document(docs[who], salts[who], np.ones(len(who), bool), place[begins], place[stops])
            yield from _table(({"doc": d, "salt": s, "known": b} for d, s, b in found), SPANS, 20_000)

    return run


def with_repeats(docs: DataFrame, sequences: Sequences, matcher: Matcher, window: int, gram: int, dtype: type, name: str, plain: Sequences | None = None) -> DataFrame:
    """``doc, salt, text, known``: in ``known``, runs of windows (first, last) that start in an earlier document.

    ``docs`` has ``doc, salt, text``. Windows of one document follow one another in it and the
    runs are disjoint, in no order. ``plain`` gives the values sent as contexts, if these differ.
    """
    spark = docs.sparkSession
    parts = partitions(spark)
    buckets = max(4 * parts, text_size(docs) // BUCKET_BYTES)
    with shuffles_removed(spark):  # the anchors, before texts and contexts move
        replies = store(
            docs.mapInArrow(_emit_anchors(sequences, window, gram, buckets), ANCHORS_DDL)
            .repartition(parts, "bucket")
            .sortWithinPartitions("bucket")
            .mapInArrow(_find_repeats, REPLIES_DDL),
            name,
        )
    texts = docs.repartition(parts, "doc", "salt")
    asked = replies.where("asked IS NOT NULL").groupBy("doc", "salt").agg(F.collect_list("asked").alias("asked"))
    looked = (
        texts.join(asked, ["doc", "salt"])
        .mapInArrow(_emit_contexts(plain or sequences, window), CONTEXTS_DDL)
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_match_contexts(matcher, window, dtype), SPANS_DDL)
    )
    every = replies.where("known IS NOT NULL").select("doc", "salt", "known").unionByName(looked)
    known = every.groupBy("doc", "salt").agg(F.collect_list("known").alias("known"))
    return texts.join(known, ["doc", "salt"], "left")


def covered(part: pa.RecordBatch, offsets: np.ndarray, window: int) -> np.ndarray:
    """Which elements of the slice a repeated window covers."""
    edges = np.zeros(int(offsets[-1]) + 1, np.int32)
    column = part.column("known")
    for row in np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False)):
        for blob in column[int(row)].as_py():
            runs = np.frombuffer(blob, np.int64).reshape(-1, 2) + offsets[row]
            np.add.at(edges, runs[:, 0], 1)
            np.add.at(edges, runs[:, 1] + window, -1)
    return np.cumsum(edges[:-1]) > 0
