"""Token ids of whole batches of text by a public byte-level BPE tokenizer.

The tokenizer first splits a text into pieces (words with the blank before them, numbers, other
characters, blanks) and encodes each piece by itself. Pieces are found here for a whole slice
of texts at once, and the tokenizer encodes each different piece only once. Texts with
characters outside the plain ranges, or with the tokenizer's special strings, are encoded by
the tokenizer as a whole.
"""

from __future__ import annotations

import os
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa

from cartulary.llm.arrays import U64, mix, ragged

MOST_PIECES = 1_500_000
# Code points whose class is known without doubt; a text with any other is encoded as a whole.
PLAIN = 0x250
SPACE, LETTER, NUMBER, OTHER, UNKNOWN = range(5)


def _class(code: int) -> int:
    if code >= PLAIN and not 0x2010 <= code <= 0x2027:
        return UNKNOWN
    kind = unicodedata.category(chr(code))
    if code in (9, 10, 11, 12, 13, 32, 0x85, 0xA0):
        return SPACE
    return LETTER if kind[0] == "L" else NUMBER if kind[0] == "N" else OTHER


CLASSES = np.array([_class(c) for c in range(0x3000)], np.uint8)


def piece_starts(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces start, among the code points of texts of plain characters."""
    size = len(codes)
    kind = CLASSES[codes]
    first = np.zeros(size + 1, bool)
    first[offsets] = True
    last = first[1:]
    change = first[:-1].copy()
    change[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    # a single blank before a run belongs to it
    joined = np.zeros(size, bool)
    joined[1:] = (codes[:-1] == 32) & ~space[1:]
    joined &= ~first[:-1]
    start = change & ~joined
    # of several blanks, the last stands alone or joins what follows
    final = space & ~last
    final[:-1] &= ~space[1:]
    start |= final
    start &= ~joined
    quote = np.flatnonzero((codes == 39) & change & ~joined)
    if len(quote):
        where = np.searchsorted(offsets, quote, "right")
        room = offsets[where] - quote
        padded = np.concatenate((codes, np.zeros(3, codes.dtype)))
        one, two = padded[quote + 1], padded[quote + 2]
        short = (room > 1) & np.isin(one, [ord(c) for c in "stmd"])
        long = (room > 2) & ~short & (((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l"))))
        start[quote[short | long] + 1] = False
        ends = np.concatenate((quote[short] + 2, quote[long] + 3))
        start[ends[ends < size]] = True
    return np.flatnonzero(start)


class Encoder:
    """Encodes texts with the tokenizer file at ``path``; remembers up to ``MOST_PIECES`` pieces."""

    def __init__(self, path: str):
        # a worker has one core; threads of the tokenizer would only wait for each other
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.keys, self.at, self.count, self.ids = np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        coded = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        count = np.array([len(c) for c in coded], np.int64)
        at = len(self.ids) + np.cumsum(count) - count
        keys, at, count = (np.concatenate(x) for x in ((self.keys, keys), (self.at, at), (self.count, count)))
        self.ids = np.concatenate((self.ids, np.array([i for c in coded for i in c], np.uint32)))
        order = np.argsort(keys, kind="stable")
        self.keys, self.at, self.count = keys[order], at[order], count[order]

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's begin."""
        whole = "".join(texts)
        codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32).astype(np.int64)
        offsets = np.cumsum([0] + [len(t) for t in texts])
        starts = piece_starts(codes, offsets)
        ends = np.append(starts[1:], len(codes))
        lengths = ends - starts
        place = np.arange(len(codes)) - np.repeat(starts, lengths)
        keys = np.zeros(0, U64)
        if len(starts):
            values = mix((codes.astype(U64) << U64(32)) + place.astype(U64))
            keys = mix(np.add.reduceat(values, starts) + lengths.astype(U64))
        if len(self.keys) > MOST_PIECES:
            self.forget()
        unique, where, back = np.unique(keys, return_index=True, return_inverse=True)
        new = np.flatnonzero(~np.isin(unique, self.keys, assume_unique=True))
        if len(new):
            self._learn(unique[new], [whole[starts[i] : ends[i]] for i in where[new]])
        spot = np.searchsorted(self.keys, unique)[back]
        count = self.count[spot]
        ids = self.ids[ragged(self.at[spot], count)]
        upto = np.concatenate(([0], np.cumsum(count)))
        return ids, upto[np.searchsorted(starts, offsets)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as the tokenizer gives them without adding special tokens."""
        plain = np.array([self._is_plain(t) for t in texts], bool)
        ids, at = self._plain([t for t, p in zip(texts, plain, strict=True) if p])
        out, number = [], 0
        for text, fits in zip(texts, plain, strict=True):
            if fits:
                out.append(ids[at[number] : at[number + 1]])
                number += 1
            else:
                out.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32))
        return out

    def _is_plain(self, text: str) -> bool:
        if any(s in text for s in self.special):
            return False
        if text.isascii():
            return True
        top = ord(max(text))
        return top < PLAIN or (top < 0x2028 and not set(map(ord, set(text))).intersection(range(PLAIN, 0x2010)))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of this worker."""
    return Encoder(path)


def texts_of(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]
