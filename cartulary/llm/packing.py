"""Packing of documents into sequences by shortest-pack-first over the length histogram.

Documents are cut at multiples of the sequence length. The histogram of piece lengths, at most
one count per length, is packed on the driver: lengths from the longest down, each into the
shortest packs that exist, by counts of equal packs, which take it as often as it fits, opening
new ones where it fits in none.
The resulting patterns are then joined back: pieces are ranked within their length, and the
rank names the pattern, its copy and the place in it.

Ranks need no pass over all pieces of a length: each partition of the pieces ranks its own,
and the counts of partitions are summed.

Results for odd input: null or empty text is one piece that holds the end token; a null id is
carried; repeated rows are packed each by itself; other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartulary.llm.arrays import slices
from cartulary.llm.shared import doc_id, keyed, read, store
from cartulary.llm.tokens import encoder, texts_of

LENGTH = 2048
END = 1
PIECES = "doc long, start long, length long, ids_crc32 long, doc_tokens long"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _tokenize(path: str, length: int):
    schema = pa.schema([(n, pa.int64()) for n in ("doc", "start", "length", "ids_crc32", "doc_tokens")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = []
            for doc, ids in zip(part.column("doc").to_pylist(), encoder(path).encode(texts_of(part.column("text"))), strict=True):
                data = np.append(ids, np.uint32(END)).astype("<u4")
                rows += [(doc, s, len(data[s : s + length]), zlib.crc32(data[s : s + length].tobytes()), len(data)) for s in range(0, len(data), length)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=schema)

    return run


def shortest_pack_first(histogram: dict[int, int], length: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in order of placement) and how many packs have each."""
    open_packs: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)  # by room left
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        for room in range(length, size - 1, -1):  # a pack that takes a piece comes again under its new room
            packs = open_packs.get(room)
            while left and packs:
                pattern, count = packs.pop()
                used = min(left, count)
                if used < count:
                    packs.append((pattern, count - used))
                open_packs[room - size].append(((*pattern, size), used))
                left -= used
            if not left:
                break
        each = length // size  # packs that hold this length alone
        while left:
            times = min(each, left)
            count = left // times
            open_packs[length - times * size].append(((size,) * times, count))
            left -= times * count
    return [p for room in sorted(open_packs) for p in open_packs[room]]


def places(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """``length, first rank, end rank, sequence of the first rank, offset`` for each place of each pattern."""
    given: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for pattern, count in patterns:
        offset = 0
        for size in pattern:
            rows.append((size, given[size], given[size] + count, sequence, offset))
            given[size] += count
            offset += size
        sequence += count
    return rows


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` for each piece of ``docs`` (``doc_id, text``)."""
    spark = docs.sparkSession
    made = keyed(docs).mapInArrow(_tokenize(path or tokenizer_path(), length), PIECES)
    pieces = store(made.withColumn("part", F.spark_partition_id()), "pieces")
    own = store(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r.length: r.n for r in own.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most one row a length
    ddl = "length long, low long, high long, sequence long, offset long"
    where = spark.createDataFrame(places(shortest_pack_first(histogram, length)), ddl)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = own.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("part", "length").orderBy("doc", "start", "ids_crc32")
    ranked = pieces.withColumn("nth", F.row_number().over(within) - 1).join(base, ["part", "length"])
    ranked = ranked.withColumn("rank", F.col("base") + F.col("nth"))
    # the places grow with the sequence length, not with the documents
    placed = ranked.join(F.broadcast(where), "length").where("rank >= low AND rank < high")
    return placed.select(
        doc_id(), "start", "length", "ids_crc32", "doc_tokens",
        (F.col("sequence") + F.col("rank") - F.col("low")).alias("sequence_id"), "offset",
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
