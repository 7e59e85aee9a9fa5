"""LM scoring by context-tree weighting over bytes.

A byte is eight binary decisions. Each decision (a place in the tree of the byte's bits) has a
context tree over the bytes before it, up to ``DEPTH``. A node of it has a Krichevsky-Trofimov
estimate from its counts, and a weighted probability: half the estimate, half the product of
its children. Both together give the posterior weight of stopping at the node, and the
prediction mixes the estimates of all depths along the path by these weights. The code length
of a text is the sum over its bytes and an end mark.

The corpus meets the model only through grams (a byte and its context): each chunk of
documents sends its different grams, with their counts in training texts, and its different
words; counts are summed by gram and word, the trees are built level by level with grouped
sums, and every chunk gets back the log probability of its grams and the counts of its words.
Nothing is broadcast, and a chunk's share does not grow with the corpus.

Results for odd input: null or empty text is scored as the end mark alone; a null id counts as
the text "null" when documents are held out, and repeated ids and rows are scored each by
itself; without training texts all counts are zero and every bit costs a bit; other columns of
the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.llm.arrays import U64, find_words, hash_spans, mix, slices, text_bytes
from cartulary.llm.repeats import by_bucket, pack, unpack
from cartulary.llm.shared import doc_id, keyed, partitions, read, store, text_size

DEPTH = 4
CHUNK_BYTES = 24_000_000
END_MARK = 0xFF  # in no UTF-8 text
_LOG10 = float(np.log(10))


def lower(raw: np.ndarray) -> np.ndarray:
    return np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)


def grams_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A gram for each byte and the end mark of each text, and the offsets of texts among them."""
    sizes = np.diff(offsets)
    pad = DEPTH + 1
    row = np.repeat(np.arange(len(sizes)), sizes)
    buffer = np.zeros(len(raw) + pad * len(sizes), np.uint8)
    buffer[np.arange(len(raw)) + row * pad + DEPTH] = raw
    ends = offsets[1:] + pad * np.arange(1, len(sizes) + 1) - 1
    buffer[ends] = END_MARK
    first = np.ones(len(buffer), bool)
    starts = offsets[:-1] + pad * np.arange(len(sizes))
    for j in range(DEPTH):
        first[starts + j] = False
    code = np.zeros(len(buffer), U64)
    for j in range(DEPTH + 1):
        code[DEPTH:] |= buffer[j : len(buffer) - DEPTH + j].astype(U64) << U64(8 * (DEPTH - j))
    return code[first], np.concatenate(([0], np.cumsum(sizes + 1)))


def words_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, words = find_words(raw, offsets)
    return hash_spans(raw, starts, ends), words


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and the sums of their counts."""
    keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def _counted(values: np.ndarray, train: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    known, counts = np.unique(values[train], return_counts=True)
    other = np.unique(values[~train])
    return [(known, counts.astype(np.int64)), (other, np.zeros(len(other), np.int64))]


REQUESTS = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("chunk", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
REQUESTS_DDL = "kind int, bucket int, chunk int, keys binary, counts binary"
GRAM, WORD = 0, 1
# Bytes of a key: a gram as it is, a word by 64 bits (of 10^9 different words about 0.03 pairs fall together).
KEY_BYTES = {GRAM: DEPTH + 1, WORD: 8}


def _ask(buckets: int):
    """The different grams and words of each chunk, with their training counts, by bucket."""

    def emit(chunk: int, held: dict[int, list]) -> Iterator[pa.RecordBatch]:
        rows = []
        for kind, parts in held.items():
            keys, counts = _merged(parts)
            bucket = mix(keys + U64(kind + 1)) % U64(buckets)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1).astype(U64))
            for b in np.flatnonzero(np.diff(edges)):
                part = order[edges[b] : edges[b + 1]]
                rows.append({"kind": kind, "bucket": int(b), "chunk": chunk, "keys": pack(keys[part], KEY_BYTES[kind]), "counts": pack(counts[part], 6)})
        yield pa.RecordBatch.from_pylist(rows, REQUESTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, {GRAM: [], WORD: []}
        for part in slices(batches):
            chunks = part.column("chunk").to_numpy(zero_copy_only=False)
            edges = np.concatenate(([0], np.flatnonzero(chunks[1:] != chunks[:-1]) + 1, [len(chunks)]))
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if chunks[a] != current:
                    if current is not None:
                        yield from emit(current, held)
                    current, held = int(chunks[a]), {GRAM: [], WORD: []}
                own = part.slice(a, b - a)
                train = ~own.column("held_out").to_numpy(zero_copy_only=False)
                raw, offsets = text_bytes(own.column("text"))
                raw = lower(raw)
                for kind, (values, at) in ((GRAM, grams_of(raw, offsets)), (WORD, words_of(raw, offsets))):
                    held[kind] = [_merged([*held[kind], *_counted(values, np.repeat(train, np.diff(at)))])]
        if current is not None:
            yield from emit(current, held)

    return run


def _sum_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for bucket, rows in by_bucket(batches):
        keys, counts = _merged([(unpack(r["keys"], KEY_BYTES[GRAM]), unpack(r["counts"], 6).astype(np.int64)) for r in rows])
        buckets = pa.array(np.full(len(keys), bucket, np.int32))
        yield pa.RecordBatch.from_arrays([buckets, pa.array(keys.astype(np.int64)), pa.array(counts)], names=["bucket", "gram", "n"])


REPLIES = pa.schema([("chunk", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()), ("values", pa.binary()), ("n", pa.int64()), ("v", pa.int64())])
REPLIES_DDL = "chunk int, kind int, keys binary, values binary, n long, v long"


def _answer_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each chunk's words with their counts in all training texts; and the totals of the bucket, once."""
    for _, rows in by_bucket(batches):
        own = [unpack(r["keys"], KEY_BYTES[WORD]) for r in rows]
        keys, counts = _merged([(k, unpack(r["counts"], 6).astype(np.int64)) for k, r in zip(own, rows, strict=True)])
        out = [{"chunk": r["chunk"], "kind": WORD, "keys": r["keys"], "values": pack(counts[np.searchsorted(keys, k)], 6)} for k, r in zip(own, rows, strict=True)]
        out.append({"chunk": -1, "kind": WORD, "n": int(counts.sum()), "v": int((counts > 0).sum())})
        yield pa.RecordBatch.from_pylist(out, REPLIES)


def _answer_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each chunk's grams with their log probabilities; the model's rows of a bucket come as chunk -1."""
    for _, rows in by_bucket(batches):
        model = [r for r in rows if r["chunk"] < 0]
        keys = np.concatenate([np.array(r["grams"], np.int64) for r in model]).astype(U64)
        logs = np.concatenate([np.array(r["logs"]) for r in model])
        order = np.argsort(keys)
        keys, logs = keys[order], logs[order]
        out = [{"chunk": r["chunk"], "kind": GRAM, "keys": r["keys"], "values": logs[np.searchsorted(keys, unpack(r["keys"], KEY_BYTES[GRAM]))].tobytes()} for r in rows if r["chunk"] >= 0]
        yield pa.RecordBatch.from_pylist(out, REPLIES)


def log_gamma(x: Column) -> Column:
    """Of x >= 1/2, by Stirling's series eight steps further on."""
    y, product = x + 8, x
    for i in range(1, 8):
        product = product * (x + i)
    return (y - 0.5) * F.log(y) - y + 0.5 * float(np.log(2 * np.pi)) + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y) - F.log(product)


def log_kt(zeros: Column, ones: Column) -> Column:
    """Log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return F.when(zeros + ones == 0, 0.0).otherwise(log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - float(np.log(np.pi)))


def _log_add(a: Column, b: Column) -> Column:
    return F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b)))


def _bits(grams: DataFrame) -> DataFrame:
    """A row for each bit of each gram's byte: context, place among the byte's decisions, and the bit."""
    byte = F.col("gram").bitwiseAND(255) + 256
    steps = F.array(*[F.struct(F.shiftright(byte, 8 - k).alias("node"), F.shiftright(byte, 7 - k).bitwiseAND(1).alias("bit")) for k in range(8)])
    return grams.select("*", F.shiftright("gram", 8).alias("context"), F.inline(steps))


def model(grams: DataFrame) -> DataFrame:
    """``bucket, gram, log_p`` for each of ``grams`` (``bucket, gram, n``): the natural log of the byte's probability in its context.

    Joins are by sorting at any size: the files of a level are several times smaller than its rows in memory, and by the
    size of the files Spark would gather a level of hundreds of thousands of nodes in the driver to broadcast it.
    """
    bits = _bits(grams)
    once = lambda b: F.sum(F.when(F.col("bit") == b, F.col("n")).otherwise(0))
    deepest = bits.groupBy("context", "node").agg(once(0).alias("zeros"), once(1).alias("ones"))
    levels = [store(deepest.withColumn("log_w", log_kt(F.col("zeros"), F.col("ones"))).withColumn("log_stop", F.lit(0.0)), "level")]
    for depth in range(DEPTH - 1, -1, -1):
        parent = F.col("context").bitwiseAND((1 << (8 * depth)) - 1).alias("context")
        level = levels[-1].groupBy(parent, "node").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("log_w").alias("below"))
        level = level.withColumn("kt", log_kt(F.col("zeros"), F.col("ones")))
        level = level.withColumn("log_w", _log_add(F.col("kt"), F.col("below")) - float(np.log(2)))
        level = level.withColumn("log_stop", F.col("kt") - float(np.log(2)) - F.col("log_w"))
        levels.append(store(level.select("context", "node", "zeros", "ones", "log_w", "log_stop"), "level"))
    one = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1.0)
    stop = F.least(F.exp("log_stop"), F.lit(1.0))
    mixed = levels[-1].select("context", "node", (stop * one).alias("p_one"), (1 - stop).alias("rest"))
    for depth in range(1, DEPTH + 1):
        above = mixed.select(F.col("context").alias("parent"), "node", F.col("p_one").alias("p"), F.col("rest").alias("r"))
        level = levels[DEPTH - depth].withColumn("parent", F.col("context").bitwiseAND((1 << (8 * (depth - 1))) - 1))
        mixed = level.join(above.hint("merge"), ["parent", "node"]).select("context", "node", (F.col("p") + F.col("r") * stop * one).alias("p_one"), (F.col("r") * (1 - stop)).alias("rest"))
    chosen = bits.select("bucket", "gram", "context", "node", "bit").join(mixed.hint("merge"), ["context", "node"])
    return chosen.groupBy("bucket", "gram").agg(F.sum(F.log(F.when(F.col("bit") == 1, F.col("p_one")).otherwise(1 - F.col("p_one")))).alias("log_p"))


SCORES = pa.schema([("doc", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("bits_per_byte", pa.float64())])
SCORES_DDL = "doc long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"


def _score(train_docs: int, train_tokens: int, vocabulary: int):
    ends = float(np.log10((train_docs + 1) / (train_tokens + vocabulary + 1)))

    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        answers = {}
        for kind, width in ((GRAM, 0), (WORD, 6)):
            rows = [r for r in replies.to_pylist() if r["kind"] == kind]
            keys = np.concatenate([np.zeros(0, U64), *[unpack(r["keys"], KEY_BYTES[kind]) for r in rows]])
            values = np.concatenate([np.zeros(0), *[unpack(r["values"], 6).astype(np.float64) if width else np.frombuffer(r["values"]) for r in rows]])
            order = np.argsort(keys)
            answers[kind] = keys[order], values[order]
        out = []
        for part in slices(iter(docs.to_batches())):
            raw, offsets = text_bytes(part.column("text"))
            raw = lower(raw)
            grams, at = grams_of(raw, offsets)
            unique, back = np.unique(grams, return_inverse=True)
            keys, logs = answers[GRAM]
            logs = logs[np.searchsorted(keys, unique)][back]
            score = np.add.reduceat(logs, at[:-1]) / _LOG10
            values, words = words_of(raw, offsets)
            unique, back = np.unique(values, return_inverse=True)
            keys, counts = answers[WORD]
            counts = counts[np.searchsorted(keys, unique)][back] if len(values) else np.zeros(0)
            sums = lambda x, w=words: np.diff(np.concatenate(([0.0], np.cumsum(x)))[w])
            base = np.zeros(part.num_rows)
            filled = np.flatnonzero(np.diff(words))
            if len(filled):
                base[filled] = np.add.reduceat(np.log10((counts + 1) / (train_tokens + vocabulary + 1)), words[:-1][filled])
            n = np.diff(words) + 1
            known = sums(counts > 0).astype(np.int64) + (train_docs > 0)
            bits = -score * np.log2(10) / np.maximum(np.diff(offsets), 1)
            arrays = [part.column("doc"), part.column("held_out"), n, known, np.full(len(n), train_tokens), base + ends, score, bits]
            out.append(pa.RecordBatch.from_arrays([pa.array(a, t) if isinstance(a, np.ndarray) else a for a, t in zip(arrays, SCORES.types, strict=True)], schema=SCORES))
        return pa.Table.from_batches(out, SCORES)

    return run


def context_tree_scores(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte`` of each of ``docs``.

    Texts whose crc32 of the id leaves 2 when divided by 7 are held out; the others train.
    """
    spark = docs.sparkSession
    parts = partitions(spark)
    rows = keyed(docs)
    chunks = int(text_size(rows) // CHUNK_BYTES) + 1
    held = F.pmod(F.crc32(F.coalesce(doc_id().cast("string"), F.lit("null")).cast("binary")), F.lit(7)) == 2
    rows = rows.select("doc", "text", held.alias("held_out"), F.pmod(F.xxhash64("doc", "salt"), F.lit(chunks)).cast("int").alias("chunk"))
    train_docs = rows.where("NOT held_out").count()
    asked = store(rows.repartition(parts, "chunk").sortWithinPartitions("chunk").mapInArrow(_ask(max(4 * parts, chunks)), REQUESTS_DDL), "requests")
    dealt = lambda kind: asked.where(F.col("kind") == kind).drop("kind").repartition(parts, "bucket").sortWithinPartitions("bucket")
    grams = store(dealt(GRAM).mapInArrow(_sum_grams, "bucket int, gram long, n long"), "grams")
    predicted = model(grams).groupBy("bucket").agg(F.collect_list(F.struct("gram", "log_p")).alias("rows"))  # a bucket has a bounded part of the grams
    predicted = predicted.select("bucket", F.lit(-1).alias("chunk"), F.lit(None).cast("binary").alias("keys"), F.col("rows.gram").alias("grams"), F.col("rows.log_p").alias("logs"))
    questions = asked.where(F.col("kind") == GRAM).select("bucket", "chunk", "keys", F.lit(None).cast("array<long>").alias("grams"), F.lit(None).cast("array<double>").alias("logs"))
    both = questions.unionByName(predicted).repartition(parts, "bucket").sortWithinPartitions("bucket")
    words = store(dealt(WORD).mapInArrow(_answer_words, REPLIES_DDL), "word-counts")
    known, distinct = words.where("chunk < 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    replies = words.where("chunk >= 0").unionByName(both.mapInArrow(_answer_grams, REPLIES_DDL)).select("chunk", "kind", "keys", "values")
    score = _score(train_docs, known + train_docs, distinct + (train_docs > 0))
    # partitions by number, which are not merged at run time: a task holds a chunk or a few
    sides = [x.repartition(max(parts, chunks), "chunk").groupBy("chunk") for x in (rows, replies)]
    scored = sides[0].cogroup(sides[1]).applyInArrow(score, SCORES_DDL)
    return scored.select(doc_id(), *[c.split()[0] for c in SCORES_DDL.split(", ")[1:]])


def op6_context_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree_scores(read(spark, sf_dir, "documents"))
