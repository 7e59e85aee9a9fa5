"""Near-duplicate documents by DartMinHash signatures.

A document is the multiset of its five-word shingles. Darts fall on the unit regions (shingle,
1st, 2nd, ... occurrence) as a Poisson process in rank: the hash of a region gives the ranks of
its darts, so that documents agree on the darts of what they share. A document looks at its
darts up to a rank at which about ``t = k ln k + 2 k`` of them hit it, whatever its size; each
dart belongs to one of ``k`` coordinates, which keeps its earliest dart. If a coordinate has
none, the rank bound doubles. Two documents agree in a coordinate with a probability equal to
their weighted Jaccard similarity.

Documents with equal words are one node. Nodes that agree in a band of coordinates are
candidates. In each bucket they are compared to one pivot, exactly, on the texts: the node that
shares buckets with the most others, which for many near copies of one text is the text
itself. Further rounds take other pivots for what is still in different components, as long
as that is much and a round joins some of it. In the end, what a bucket still holds of
different components is compared pair by pair, except where the sizes or the distances to the
first pivot rule a link out (the distance is a metric), or where the regions of the two share too
few; of documents with more than ``MOST_REGIONS`` one-bit sketches of all coordinates stand for
these. Buckets are cut into blocks of about ``BLOCK`` members, and each two blocks meet in one
place, where the regions shared by all their pairs are one product of two matrices. Little more
than links comes out of it, and is then verified on the texts. Copies and near copies in
thousands cost a comparison each, and every candidate link between components is decided.

Results for odd input: documents of one to four words are one shingle; those without words
(null, empty, blank) are classes of their own; rows without an id and repeated rows take part
like others; the class id is the least id in it, null if it has none; other columns of the
input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.llm.arrays import U64, find_words, grams, hash_spans, mix, rows_of, slices, text_bytes
from cartulary.llm.components import components
from cartulary.llm.shared import NO_ID, keyed, partitions, read, store

SHINGLE = 5
SIMILARITY = 0.8
# At similarity 0.8 a band of eight coordinates agrees with 0.17, one of forty all but surely;
# at 0.5, which a shared passage brings about, one of forty agrees with 0.15.
COORDINATES, BANDS = 320, 40
# Bits of two sketches (one bit a coordinate) that may differ: at similarity 0.8 these are 32, with a
# deviation of 5.4, so that one pair in millions exceeds this; at 0.5 they are 80.
SKETCH_RADIUS = 60
# Pairs left per member of a bucket, above which another round of pivots is worth its jobs.
MANY_PAIRS = 2
# Documents with more regions than this are compared by their sketches, then on their texts.
MOST_REGIONS = 2_048
# Members of a bucket that are compared in one place to as many others, and columns of a matrix at once.
BLOCK, COLUMNS = 1_024, 4_096
# Regions are compared by 32 bits; so many of those that a link shares may fall together.
REGIONS_LOST = 2
_STEP = U64(0xD1342543DE82EF95)


def shingles(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes document by document, their number in each, and a 128-bit key of its words."""
    starts, ends, words = find_words(raw, offsets)
    values = hash_spans(raw, starts, ends)
    n = np.diff(words)
    out = np.zeros(0, U64)
    count = np.where(n == 0, 0, np.maximum(n - SHINGLE + 1, 1))
    size = np.minimum(n, SHINGLE)
    first = np.repeat(words[:-1], count) + (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
    out = np.empty(len(first), U64)
    width = np.repeat(size, count)
    for length in range(1, SHINGLE + 1):
        which = width == length
        if which.any():
            out[which] = grams(values, length)[first[which]] + U64(length)
    keys = np.zeros((len(n), 2), U64)
    filled = np.flatnonzero(n)
    if len(filled):
        place = np.arange(len(values), dtype=U64) - np.repeat(words[:-1], n).astype(U64)
        for i, salt in enumerate((U64(0x9FB21C651E98DF25), U64(0xC13FA9A902A6328F))):
            keys[filled, i] = np.add.reduceat(mix((values ^ salt) + place * _STEP), words[:-1][filled])
    return out, count, keys


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((mix(x) >> U64(11)).astype(np.float64) + 0.5) / 9007199254740992.0


def _times(number: int) -> np.uint64:
    return U64(number * 0xA0761D6478BD642F & 0xFFFFFFFFFFFFFFFF)


def _regions(prints: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The unit regions of all documents and their owners: of a repeated shingle its 1st, 2nd, ... unit of weight."""
    owner = rows_of(count)
    order = np.lexsort((prints, owner))
    prints = prints[order]
    new = np.concatenate(([True], (prints[1:] != prints[:-1]) | (owner[1:] != owner[:-1]))) if len(prints) else np.zeros(0, bool)
    lead = np.flatnonzero(new)
    rank = np.arange(len(prints)) - np.repeat(lead, np.diff(np.append(lead, len(prints))))
    return mix(prints + rank.astype(U64) * _STEP), owner


def signatures(prints: np.ndarray, count: np.ndarray, k: int = COORDINATES) -> np.ndarray:
    """The earliest dart of each of ``k`` coordinates, one row a document; documents without shingles get zeros."""
    out = np.zeros((len(count), k), U64)
    regions, owner = _regions(prints, count)
    darts = k * np.log(k) + 2 * k
    todo = np.flatnonzero(count)
    reach = np.zeros(len(count))
    reach[todo] = darts / count[todo]
    active = np.arange(len(regions))
    while len(todo):
        seed, who = regions[active], owner[active]
        at, number, found = -np.log(_uniform(seed)), 0, []
        while len(seed):
            near = at < reach[who]
            seed, who, at = seed[near], who[near], at[near]
            dart = mix(seed ^ _times(number + 1))
            found.append((who * k + (dart % U64(k)).astype(np.int64), at, dart))
            number += 1
            at = at - np.log(_uniform(seed + _times(number)))
        slot, at, dart = (np.concatenate(x) for x in zip(*found, strict=True))
        least = np.full(out.size, np.inf)
        np.minimum.at(least, slot, at)
        first = at == least[slot]
        slot, dart = slot[first], dart[first]
        earliest = np.full(out.size, np.iinfo(U64).max, U64)  # of several darts at once the least
        np.minimum.at(earliest, slot, dart)
        hit = np.flatnonzero(np.isfinite(least))
        out.reshape(-1)[hit] = earliest[hit]
        full = np.bincount(hit // k, minlength=len(count))
        todo = todo[full[todo] < k]
        reach[todo] *= 2
        keep = np.zeros(len(count), bool)
        keep[todo] = True
        active = active[keep[owner[active]]]
    return out


SIGNED = "doc long, salt binary, k1 long, k2 long, size long, bands array<long>, sketch array<long>"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, most=2_000_000):
        prints, count, keys = shingles(*text_bytes(part.column("text")))
        signed = signatures(prints, count)
        sketch = np.packbits((signed >> U64(40) & U64(1)).astype(np.uint8), axis=1).view(np.int64)
        signed = signed.reshape(len(count), BANDS, -1)
        bands = np.zeros((len(count), BANDS), U64)
        for i in range(signed.shape[2]):
            bands = mix(bands * _STEP + signed[:, :, i])
        rows = [b if n else None for b, n in zip(bands.view(np.int64).tolist(), count, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [part.column("doc"), part.column("salt"), pa.array(keys[:, 0].view(np.int64)), pa.array(keys[:, 1].view(np.int64)), pa.array(count.astype(np.int64)), pa.array(rows, pa.list_(pa.int64())), pa.array(sketch.tolist(), pa.list_(pa.int64()))],
            names=["doc", "salt", "k1", "k2", "size", "bands", "sketch"],
        )


def _region_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        prints, count, _ = shingles(*text_bytes(part.column("text")))
        regions, _ = _regions(prints, count)
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(count)).astype(np.int32)), pa.array(regions.astype(np.uint32).view(np.int32)))
        few = pa.array(count <= MOST_REGIONS)
        yield pa.RecordBatch.from_arrays([part.column("node"), pc.if_else(few, lists, pa.scalar(None, lists.type))], names=["node", "regions"])


def similarity(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets: distinct values in order, and their counts."""
    (a, n), (b, m) = one, other
    spot = np.minimum(np.searchsorted(b, a), len(b) - 1)
    same = b[spot] == a
    shared = int(np.minimum(n[same], m[spot[same]]).sum())
    return shared / (int(n.sum()) + int(m.sum()) - shared)


def multiset(text: str) -> tuple[np.ndarray, np.ndarray]:
    data = text.encode()
    prints, _, _ = shingles(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    return np.unique(prints, return_counts=True)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, bag = None, None
    for batch in batches:
        out = []
        for a, text, other in zip(batch.column("a").to_pylist(), batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist(), strict=True):
            if a != held:
                held, bag = a, multiset(text)
            out.append(similarity(bag, multiset(other)))
        names = ["a", "b", "component_a", "component_b"]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(out, pa.float64())], names=[*names, "similarity"])


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``a, b, component_a, component_b, similarity`` of each pair of nodes."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "component_a", "component_b", "text_a", "text_b")
    return joined.mapInArrow(_compare, "a long, b long, component_a long, component_b long, similarity double")


def _pivots(members: DataFrame, turn: int) -> DataFrame:
    """``band, key, pivot, pivot_component``: the most central member of each bucket, by turns of the others."""
    last = F.struct((F.col("used") > 0).cast("int"), -F.col("centrality"), F.xxhash64("node", F.lit(turn)), "node", "component", "size")
    found = members.groupBy("band", "key").agg(F.min(last).alias("least"))
    return found.select("band", "key", F.col("least.node").alias("pivot"), F.col("least.component").alias("pivot_component"), F.col("least.size").alias("pivot_size"))


def _sizes_allow(a: Column, b: Column) -> Column:
    """Multisets of these sizes may be similar."""
    return F.least(a, b) >= SIMILARITY * F.greatest(a, b) - 1e-9


BLOCKS = ["band", "key", "low", "high"]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of rows of the same two blocks."""
    held, last = [], None
    for batch in batches:
        keys = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in BLOCKS], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for low, high in pairwise([0, *cuts.tolist(), len(keys)] if len(keys) else []):
            now = tuple(keys[low])
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(low, high - low))
            last = now
    if held:
        yield pa.Table.from_batches(held)


def shared_regions(values: np.ndarray, count: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many values each list ``x`` shares with each list ``y``; the lists follow one another in ``values``."""
    _, column, often = np.unique(values, return_inverse=True, return_counts=True)
    twice = often > 1
    kept = twice[column]
    column, owner = (np.cumsum(twice) - 1)[column[kept]], rows_of(count)[kept]
    order = np.argsort(column)
    column, owner = column[order], owner[order]
    shared = np.zeros((len(x), len(y)), np.float32)
    for start in range(0, int(twice.sum()), COLUMNS):
        low, high = np.searchsorted(column, [start, start + COLUMNS])
        present = np.zeros((len(count), int(column[high - 1]) - start + 1), np.float32)
        present[owner[low:high], column[low:high] - start] = 1
        shared += present[x] @ present[y].T
    return shared


def _likely(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the two members of each pair that may be linked."""
    part, low, high, component, size = (group.column(n).to_numpy() for n in ("part", "low", "high", "component", "size"))
    distance = group.column("d").to_numpy().astype(float)
    x, y = np.flatnonzero(part == low[0]), np.flatnonzero(part == high[0])
    may = component[x][:, None] != component[y]
    if low[0] == high[0]:
        may &= x[:, None] < y
    may &= np.minimum(size[x][:, None], size[y]) >= SIMILARITY * np.maximum(size[x][:, None], size[y]) - 1e-9
    may &= ~(np.abs(distance[x][:, None] - distance[y]) > 1 - SIMILARITY + 1e-9)  # not known: may
    x, y, may = x[may.any(axis=1)], y[may.any(axis=0)], may[may.any(axis=1)][:, may.any(axis=0)]
    if not len(x):
        return x, y
    regions = group.column("regions").combine_chunks()
    count = pc.fill_null(pc.list_value_length(regions), 0).to_numpy()
    shared = shared_regions(regions.flatten().to_numpy(), count, x, y)
    least = SIMILARITY / (1 + SIMILARITY) * (size[x][:, None] + size[y]) - REGIONS_LOST
    listed = count > 0
    known = listed[x][:, None] & listed[y]
    i, j = np.nonzero(may & (~known | (shared >= least - 1e-6)))
    sketch = group.column("sketch").combine_chunks().flatten().to_numpy().reshape(len(part), -1)
    differ = np.bitwise_count(sketch[x[i]] ^ sketch[y[j]]).sum(axis=1)
    right = known[i, j] | (differ <= SKETCH_RADIUS)
    return x[i[right]], y[j[right]]


def _test_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in _groups(batches):
        x, y = _likely(group)
        if len(x):
            node, component = group.column("node").to_numpy(), group.column("component").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (node[x], node[y], component[x], component[y])], names=["a", "b", "component_a", "component_b"])


def _pairs_of_blocks(ring: DataFrame) -> DataFrame:
    """``a, b, component_a, component_b`` of all pairs within buckets that may be linked, perhaps more than once."""
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    block = ring.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    block = block.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    block = block.select("band", "key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "node", "component", "size", "d", "sketch", "regions")
    dealt = block.repartition(partitions(ring.sparkSession), *BLOCKS).sortWithinPartitions(*BLOCKS)
    return dealt.mapInArrow(_test_blocks, "a long, b long, component_a long, component_b long")


def _pairs_of_pivot(members: DataFrame, pivots: DataFrame) -> DataFrame:
    """In each bucket, the pivot with every member of another component."""
    joined = members.join(pivots, ["band", "key"]).where("component <> pivot_component").where(_sizes_allow(F.col("size"), F.col("pivot_size")))
    return joined.select(F.col("pivot").alias("a"), F.col("node").alias("b"), F.col("pivot_component").alias("component_a"), F.col("component").alias("component_b")).distinct()


def _open_buckets(members: DataFrame, scores: DataFrame, pivots: DataFrame) -> DataFrame:
    """The members of buckets that still hold several components, after the links of a round."""
    links = scores.where(F.col("similarity") >= SIMILARITY).select(F.col("component_a").alias("a"), F.col("component_b").alias("b"))
    joined = components(links).select(F.col("node").alias("component"), F.col("component").alias("new"))
    used = pivots.select("band", "key", F.col("pivot").alias("node"), F.lit(1).alias("now"))
    now = members.join(joined, "component", "left").join(used, ["band", "key", "node"], "left")
    now = now.select("band", "key", "node", "size", F.coalesce("new", "component").alias("component"), "centrality", (F.col("used") + F.coalesce("now", F.lit(0))).alias("used"))
    mixed = now.groupBy("band", "key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    return now.join(mixed.select("band", "key"), ["band", "key"], "left_semi")


def _pairs_left(members: DataFrame) -> tuple[int, int]:
    """Members of open buckets, and their pairs of different components."""
    sizes = members.groupBy("band", "key", "component").agg(F.count("*").cast("double").alias("n"))
    each = sizes.groupBy("band", "key").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("own"))
    row = each.agg(F.coalesce(F.sum("n"), F.lit(0.0)), F.coalesce(F.sum((F.col("n") * F.col("n") - F.col("own")) / 2), F.lit(0.0))).first()
    return int(row[0]), int(row[1])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc, salt, row, component, class_doc, class_row, class_size`` for each row of ``keyed`` documents.

    ``class_row`` is the row of the class with the least id that represents it.
    """
    signed = store(docs.mapInArrow(_sign, SIGNED).withColumn("row", F.monotonically_increasing_id()), "signatures")
    copies = signed.where("bands IS NOT NULL").groupBy("k1", "k2").agg(F.min("row").alias("node"))
    rows = signed.join(copies, ["k1", "k2"], "left").select("doc", "salt", "row", F.when(F.col("bands").isNull(), F.col("row")).otherwise(F.col("node")).alias("node"))
    rows = store(rows, "rows")
    nodes = signed.join(copies.select(F.col("node").alias("row")), "row", "left_semi")
    band = nodes.select(F.col("row").alias("node"), "size", F.posexplode("bands").alias("band", "key"))
    shared = band.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    members = store(band.join(shared, ["band", "key"]), "bands")
    central = members.groupBy("node").agg(F.sum("n").alias("centrality"))
    members = store(members.join(central, "node").select("band", "key", "node", "size", F.col("node").alias("component"), "centrality", F.lit(0).alias("used")), "buckets")
    wanted = members.select(F.col("node").alias("row")).distinct().join(signed.select("row", "doc", "salt"), "row")
    found = docs.repartition(partitions(docs.sparkSession), "doc", "salt").join(wanted, ["doc", "salt"])
    texts = store(found.groupBy("row").agg(F.first("text").alias("text")).withColumnRenamed("row", "node"), "texts")

    first = store(_pivots(members, 0), "pivots")
    tested, pivots, turn, before = None, first, 0, None
    while True:
        pairs = _pairs_of_pivot(members, pivots)
        if tested is not None:
            pairs = pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")
        scores = store(_verify(pairs, texts), "scores")
        tested = scores if tested is None else tested.unionByName(scores)
        members = store(_open_buckets(members, scores, pivots), "buckets")
        count, left = _pairs_left(members)
        if left <= MANY_PAIRS * count or (before is not None and left > 0.9 * before):
            break
        turn, before = turn + 1, left
        pivots = store(_pivots(members, turn), "pivots")
    # what is left, pair by pair within the ring that the distance to the first pivot allows
    pivot = first.select("band", "key", F.col("pivot").alias("p"))
    distance = tested.select(F.col("a").alias("p"), F.col("b").alias("node"), (1 - F.col("similarity")).alias("d"))
    held = members.groupBy("band", "key").agg(F.count("*").alias("n"))
    ring = members.join(held.join(pivot, ["band", "key"]), ["band", "key"]).join(distance.dropDuplicates(["p", "node"]), ["p", "node"], "left")
    ring = ring.withColumn("d", F.when(F.col("p") == F.col("node"), 0.0).otherwise(F.col("d")))
    regions = texts.join(members.select("node").distinct(), "node", "left_semi").mapInArrow(_region_lists, "node long, regions array<int>")
    ring = ring.join(signed.select(F.col("row").alias("node"), "sketch").join(regions, "node"), "node")
    rest = _pairs_of_blocks(ring).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(F.col("a") < F.col("b"), F.col("component_a")).otherwise(F.col("component_b")).alias("component_a"), F.when(F.col("a") < F.col("b"), F.col("component_b")).otherwise(F.col("component_a")).alias("component_b")).distinct()
    done = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    scores = store(_verify(rest.join(done, ["a", "b"], "left_anti"), texts), "scores")
    links = tested.unionByName(scores).where(F.col("similarity") >= SIMILARITY).select("a", "b")
    joined = components(links)
    rows = rows.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    classes = rows.groupBy("component").agg(F.min(F.struct("doc", "row")).alias("least"), F.count("*").alias("class_size"))
    classes = classes.select("component", F.col("least.doc").alias("class_doc"), F.col("least.row").alias("class_row"), "class_size")
    return rows.join(classes, "component")


def minhash_dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id, class_size, is_kept`` for each row of ``docs`` (``doc_id, text``)."""
    found = near_duplicates(keyed(docs))
    none = F.lit(NO_ID)
    return found.select(F.nullif(F.col("doc"), none).alias("doc_id"), F.nullif(F.col("class_doc"), none).alias("class_id"), "class_size", (F.col("row") == F.col("class_row")).alias("is_kept"))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup(read(spark, sf_dir, "documents"))
