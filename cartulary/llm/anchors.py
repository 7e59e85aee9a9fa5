"""Content-chosen anchors: every window of a sequence picks one short gram inside it.

A window of ``window`` consecutive elements picks its gram of ``gram`` elements with the
smallest fingerprint, the leftmost of equals. The choice depends on the window's content
alone, so equal windows pick equal anchors at the same place within them. Neighbouring
windows mostly pick the same occurrence, which leaves about two anchors per ``window - gram
+ 2`` elements. What repeats elsewhere can therefore be found through anchors alone.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from cartulary.llm.arrays import U64, grams

PIECE = 1 << 19
_INDEX = U64((1 << 20) - 1)


class Anchors(NamedTuple):
    """``at``: position of the gram; ``first`` to ``last``: the windows (starts) that pick it."""

    at: np.ndarray
    first: np.ndarray
    last: np.ndarray
    print: np.ndarray


def _pick(values: np.ndarray, room: np.ndarray, window: int, gram: int) -> Anchors:
    """``room``: elements from each position to the end of its document."""
    prints = grams(values, gram)
    ranks = (prints & ~_INDEX) | np.arange(len(prints), dtype=U64)
    width, have, least = window - gram + 1, 1, ranks
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    fits = np.flatnonzero(room[: len(least)] >= window)
    at = (least[fits] & _INDEX).astype(np.int64)
    edge = np.flatnonzero(at[1:] != at[:-1]) + 1 if len(at) else np.zeros(0, np.int64)
    lead = np.concatenate((np.zeros(min(1, len(at)), np.int64), edge))
    tail = np.concatenate((edge, [len(at)]))[: len(lead)] - 1
    at = at[lead]
    return Anchors(at, fits[lead], fits[tail], prints[at])


def pick_anchors(values: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> Anchors:
    """Anchors of all documents that lie at ``offsets`` in ``values``.

    Long inputs are processed in pieces that overlap by a window less one element; the
    windows of an anchor that two pieces share are then listed with both, each once.
    """
    room = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(values))
    found, start, overlap = [], 0, window - 1
    while len(values) - start >= window:
        stop = min(start + PIECE, len(values))
        part = _pick(values[start:stop], np.minimum(room[start:stop], stop - start - np.arange(stop - start)), window, gram)
        found.append(Anchors(part.at + start, part.first + start, part.last + start, part.print))
        if stop == len(values):
            break
        start = stop - overlap
    if not found:
        none = np.zeros(0, np.int64)
        return Anchors(none, none, none, np.zeros(0, U64))
    return Anchors(*(np.concatenate(x) for x in zip(*found, strict=True)))
