"""Substring dedup by lookup of word windows in earlier blocks, in place of a Lempel-Ziv parse.

The reference is the corpus itself, cut into blocks and indexed through anchors (see
``repeats``): every window of 13 words has its place in exactly one bucket, and documents are
held against all reference blocks of their buckets that come before them. Each window is
looked up by itself; no factor is extended and no source position kept. What the windows found
cover becomes duplicate spans.

Results for odd input: null or empty text has no words; a null id comes after all ids and
before none; rows of one id never remove one another's words; equal rows get equal results;
other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.llm import repeats
from cartulary.llm.arrays import U64, find_words, grams, hash_spans, ragged, slices, text_bytes
from cartulary.llm.shared import doc_id, keyed, read

WINDOW = 13
GRAM = 6
BLOCK = 8192


def _sequences(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, words = find_words(raw, offsets)
    return hash_spans(raw, starts, ends), words


def factor(values: np.ndarray, size: np.ndarray, docs: np.ndarray, window: int, block: int = BLOCK) -> np.ndarray:
    """For each window of the segments, whether a factor of an earlier document covers it.

    Segments come in the order of their documents. They are taken block by block: each block
    is parsed against the index of every block before it and against itself, then indexed.
    """
    counts = size - window + 1
    prints = grams(values, window)[ragged(np.cumsum(size) - size, counts)] if len(values) else np.zeros(0, U64)
    place = np.concatenate(([0], np.cumsum(counts)))
    owner = np.repeat(docs, counts)
    hit = np.zeros(len(prints), bool)
    index: list[tuple[np.ndarray, np.ndarray]] = []
    for start in range(0, len(size), block):
        low, high = place[start], place[min(start + block, len(size))]
        part, who = prints[low:high], owner[low:high]
        order = np.argsort(part, kind="stable")
        lead, sizes = repeats.grouped(part[order])
        keys, sources = part[order][lead], who[order][lead]
        index.append((keys, sources))
        for held, source in index:
            spot = np.minimum(np.searchsorted(held, part), len(held) - 1)
            # the longest factor from here on is at least a window long, in this block
            hit[low:high] |= (held[spot] == part) & (source[spot] < who)
    return hit


def _cut(window: int):
    schema = pa.schema([("doc", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("spans", pa.list_(pa.list_(pa.int64())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            raw, offsets = text_bytes(part.column("text"))
            starts, ends, words = find_words(raw, offsets)
            gone = repeats.covered(part, words, window)
            lengths = np.where(gone, 0, ends - starts + 1)
            # each kept word with one byte before it, which becomes the space between
            body = np.concatenate((np.full(1, 32, np.uint8), raw))[ragged(starts, lengths)]
            at = np.concatenate(([0], np.cumsum(lengths)))
            body[at[:-1][lengths > 0]] = 32
            text_at = at[words]
            kept = [body[a + 1 : b].tobytes().decode() if b > a else "" for a, b in zip(text_at[:-1], text_at[1:], strict=True)]
            removed = np.concatenate(([0], np.cumsum(gone)))
            spans = []
            for a, b in zip(words[:-1], words[1:], strict=True):
                if removed[b] == removed[a]:
                    spans.append([])
                    continue
                own = np.diff(np.concatenate(([0], gone[a:b].astype(np.int8), [0])))
                spans.append(np.stack((np.flatnonzero(own == 1), np.flatnonzero(own == -1)), 1).tolist())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), pa.array(np.diff(words)), pa.array(removed[words[1:]] - removed[words[:-1]]), pa.array(kept, pa.string()), pa.array(spans, schema.field("spans").type)],
                schema=schema,
            )

    return run


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_words, n_removed, kept, spans`` for each row of ``docs`` (``doc_id, text``).

    ``kept`` has the words left, joined by one space; ``spans`` the removed runs of words, as
    [start, stop).
    """
    found = repeats.with_repeats(keyed(docs), _sequences, factor, window, gram, np.uint64, "substring-dedup")
    ddl = "doc long, n_words long, n_removed long, kept string, spans array<array<long>>"
    return found.mapInArrow(_cut(window), ddl).select(doc_id(), "n_words", "n_removed", "kept", "spans")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), F.size("spans").cast("long").alias("n_spans"))
