"""Packing where one short length is frequent: existing packs take it as often as it fits."""

from __future__ import annotations

import heapq
from collections import Counter

import pytest

from cartulary.llm.packing import shortest_pack_first


def one_by_one(histogram, length):
    """Rooms left after shortest-pack-first, piece by piece."""
    rooms = []
    for size in sorted(histogram, reverse=True):
        for _ in range(histogram[size]):
            room = -heapq.heappop(rooms) if rooms and -rooms[0] >= size else length
            heapq.heappush(rooms, size - room)
    return Counter(-r for r in rooms)


@pytest.mark.parametrize("histogram, packs", [({1500: 1000, 10: 50_000}, 1000), ({1200: 1000, 60: 14_000}, 1000), ({2000: 3, 700: 500, 300: 40, 7: 90_000, 1: 5}, None)])
def test_frequent_short_length(histogram, packs):
    rooms, placed = Counter(), Counter()
    for pattern, count in shortest_pack_first(histogram, 2048):
        rooms[2048 - sum(pattern)] += count
        for size in pattern:
            placed[size] += count
    assert rooms == one_by_one(histogram, 2048) and placed == histogram
    if packs:
        assert rooms.total() == packs
        assert sum(r * n for r, n in rooms.items()) / (2048 * packs) < 0.03
