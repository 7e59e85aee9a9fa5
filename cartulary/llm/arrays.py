"""Numpy views of Arrow text: bytes, words and fingerprints of a whole batch at a time.

Texts of a batch lie one after another in one byte buffer, so that words and fingerprints of
thousands of documents are computed by a handful of array operations. Batches are cut into
slices of bounded size; what is longer than a slice is processed in overlapping pieces by
those who need it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 4_000_000
HASH_BYTES = 1 << 20
MULTIPLIER = U64(0x9E3779B97F4A7C15 | 1)

# Every byte but the blanks \x20 and \x09-\x0D belongs to a word.
IN_WORD = np.ones(256, bool)
IN_WORD[[9, 10, 11, 12, 13, 32]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * MULTIPLIER)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.ones(n, U64)
    if n > 1:
        out[1:] = U64(base)
        np.multiply.accumulate(out, out=out)
    return out


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, extended when needed."""

    def __init__(self) -> None:
        self.size = 0

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.size:
            base = int(MULTIPLIER)
            self.size = max(n, HASH_BYTES + 1)
            self.up, self.down = _powers(self.size, base), _powers(self.size, pow(base, -1, 1 << 64))
        return self.up, self.down


powers = _Powers()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, and the offsets of the documents in it; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1] if ends else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with texts of about ``most`` bytes together; one longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def find_words(raw: np.ndarray, offsets: np.ndarray, in_word: np.ndarray = IN_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte positions where words start and end, and the number of words before each document."""
    inside = in_word[raw]
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    if len(raw):
        cuts = offsets[(offsets > 0) & (offsets < len(raw))]
        before[0] = after[-1] = False
        before[cuts] = False
        after[cuts - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; spans are in order and do not overlap."""
    out = np.empty(len(starts), U64)
    at = 0
    while at < len(starts):
        to = max(int(np.searchsorted(ends, starts[at] + HASH_BYTES, "right")), at + 1)
        base, size = starts[at], ends[to - 1] - starts[at]
        up, down = powers(int(size) + 1)
        sums = np.zeros(size + 1, U64)
        np.cumsum(BYTE_VALUES[raw[base : base + size]] * up[:size], out=sums[1:])
        first, last = starts[at:to] - base, ends[at:to] - base
        out[at:to] = (sums[last] - sums[first]) * down[first] + (last - first).astype(U64)
        at = to
    return mix(out)


def grams(values: np.ndarray, n: int) -> np.ndarray:
    """Fingerprint of the ``n`` values from each position on; meaningless within ``n`` of the end."""
    size = len(values)
    if size < n:
        return np.zeros(0, U64)
    parts, bit, have = [], 1, values
    while bit <= n:
        if n & bit:
            parts.append((bit, have))
        bit *= 2
        if bit <= n:
            half = bit // 2
            factor = U64(pow(int(MULTIPLIER), half, 1 << 64))
            have = have[: len(have) - half] * factor + have[half:]
    count, at = size - n + 1, 0
    out = np.zeros(count, U64)
    for length, part in reversed(parts):
        out *= U64(pow(int(MULTIPLIER), length, 1 << 64))
        out += part[at : at + count]
        at += length
    return mix(out)


def rows_of(lengths: np.ndarray) -> np.ndarray:
    """Row number of every element of ragged rows of these lengths."""
    return np.repeat(np.arange(len(lengths)), lengths)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``start, start + 1, ...`` of ragged rows, one row after another."""
    total = int(lengths.sum())
    firsts = np.cumsum(lengths) - lengths
    return np.arange(total) - np.repeat(firsts - starts, lengths)
