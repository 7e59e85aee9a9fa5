"""Substring dedup over bytes by a logarithmic family of suffix arrays.

Suffixes matter up to 50 bytes and only where an anchor occurs in several documents in
different contexts (see ``repeats``, which routes equal strings to one bucket and settles
equal contexts). Within a bucket, contexts arrive in batches in the order of their documents.
Each batch gets the sorted array of its suffixes, with the earliest document of each; it is
merge-scanned against the levels that exist and becomes a level itself; levels of equal size
merge into one of twice the size, so a suffix is merged a logarithmic number of times.

Results for odd input: null text is empty; a null id comes after all ids and before none; rows
of one id never remove one another's bytes; equal rows get equal results; texts shorter than
50 bytes stay; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.llm import repeats
from cartulary.llm.arrays import BYTE_VALUES, ragged, slices, text_bytes
from cartulary.llm.shared import doc_id, keyed, read

WINDOW = 50
GRAM = 16
BATCH = 4096


def _sequences(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return BYTE_VALUES[raw], offsets


def _bytes_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return raw, offsets


class SuffixLevels:
    """Sorted suffixes of ``width`` bytes with the earliest document of each, in levels of rank 0, 1, ..."""

    def __init__(self, width: int):
        self.width = width
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []

    def scan(self, suffixes: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Whether an earlier document has the suffix; suffixes are sorted."""
        hit = np.zeros(len(suffixes), bool)
        for _, held, owners in self.levels:
            spot = np.minimum(np.searchsorted(held, suffixes), len(held) - 1)
            hit |= (held[spot] == suffixes) & (owners[spot] < docs)
        return hit

    def add(self, suffixes: np.ndarray, docs: np.ndarray) -> None:
        """A new level; suffixes are sorted, and by document where equal."""
        first, _ = repeats.grouped(suffixes)
        rank, suffixes, docs = 0, suffixes[first], docs[first]
        while self.levels and self.levels[-1][0] == rank:
            _, other, owners = self.levels.pop()
            suffixes, docs = np.concatenate((other, suffixes)), np.concatenate((owners, docs))
            order = np.argsort(suffixes, kind="stable")  # equal ones: the older level's first
            suffixes, docs = suffixes[order], docs[order]
            first, _ = repeats.grouped(suffixes)
            rank, suffixes, docs = rank + 1, suffixes[first], docs[first]
        self.levels.append((rank, suffixes, docs))


def match(values: np.ndarray, size: np.ndarray, docs: np.ndarray, window: int, batch: int = BATCH) -> np.ndarray:
    """For each window of the contexts, whether an earlier document has it; contexts are in document order."""
    counts = size - window + 1
    at = ragged(np.cumsum(size) - size, counts)
    place = np.concatenate(([0], np.cumsum(counts)))
    owner = np.repeat(docs, counts)
    views = np.lib.stride_tricks.sliding_window_view(values, window) if len(values) >= window else np.zeros((0, window), np.uint8)
    hit, family = np.zeros(len(at), bool), SuffixLevels(window)
    for start in range(0, len(size), batch):
        low, high = place[start], place[min(start + batch, len(size))]
        suffixes = np.ascontiguousarray(views[at[low:high]]).view(f"S{window}").ravel()
        order = np.argsort(suffixes, kind="stable")
        ranked, who = suffixes[order], owner[low:high][order]
        first, sizes = repeats.grouped(ranked)
        hit[low + order] = (np.repeat(who[first], sizes) < who) | family.scan(ranked, who)
        family.add(ranked, who)
    return hit


def _cut(window: int):
    schema = pa.schema([("doc", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary()), ("spans", pa.list_(pa.list_(pa.int64())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            raw, offsets = text_bytes(part.column("text"))
            gone = repeats.covered(part, offsets, window)
            removed = np.concatenate(([0], np.cumsum(gone)))
            kept, spans = [], []
            for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                if removed[b] == removed[a]:
                    kept.append(raw[a:b].tobytes())
                    spans.append([])
                    continue
                kept.append(raw[a:b][~gone[a:b]].tobytes())
                edge = np.diff(np.concatenate(([0], gone[a:b].astype(np.int8), [0])))
                spans.append(np.stack((np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)), 1).tolist())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), pa.array(np.diff(offsets)), pa.array(removed[offsets[1:]] - removed[offsets[:-1]]), pa.array(kept, pa.binary()), pa.array(spans, schema.field("spans").type)],
                schema=schema,
            )

    return run


def suffix_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, n_removed, kept, spans`` for each row of ``docs`` (``doc_id, text``).

    ``kept`` has the bytes left, which need not be valid UTF-8; ``spans`` the maximal removed
    runs of bytes, as [start, stop).
    """
    found = repeats.with_repeats(keyed(docs), _sequences, match, window, gram, np.uint8, "suffix-dedup", _bytes_of)
    ddl = "doc long, n_bytes long, n_removed long, kept binary, spans array<array<long>>"
    return found.mapInArrow(_cut(window), ddl).select(doc_id(), "n_bytes", "n_removed", "kept", "spans")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
