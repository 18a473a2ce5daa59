"""Packing plans: whole, never above best fit decreasing, least where small cases show it."""

import bisect
import itertools
import random
from collections import Counter

import pytest

pytest.importorskip("marketlake.llm")

from marketlake.llm import packing  # noqa: E402


def sequences(patterns, histogram, capacity):
    """Number of sequences of a plan that holds every piece once and nothing too long."""
    held, first = Counter(), 0
    for start, times, lengths in patterns:
        assert start == first and times > 0 and lengths and sum(lengths) <= capacity
        first += times
        for n in lengths:
            held[n] += times
    assert held == Counter({n: c for n, c in histogram.items() if n > 0 and c > 0})
    return first


def best_fit(histogram, capacity):
    rooms, used = [], 0
    for n in sorted(Counter(histogram).elements(), reverse=True):
        at = bisect.bisect_left(rooms, n)
        room = rooms.pop(at) if at < len(rooms) else capacity
        used += room == capacity
        bisect.insort(rooms, room - n)
    return used


def fewest(pieces, capacity):
    """By trying all ways."""
    best = len(pieces)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best and i < len(pieces):
            return
        if i == len(pieces):
            best = min(best, len(rooms))
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= pieces[i]}.values():
            rooms[k] -= pieces[i]
            place(i + 1, rooms)
            rooms[k] += pieces[i]
        place(i + 1, [*rooms, capacity - pieces[i]])

    place(0, [])
    return best


def made(seed, low, high, n):
    rng = random.Random(seed)
    return Counter(rng.randint(low, high) for _ in range(n))


@pytest.mark.parametrize(
    "histogram",
    [
        made(1, 1, 4096, 20_000),
        made(2, 900, 1499, 3_000),
        made(3, 1300, 2100, 3_000),
        {1: 5_000},
        {1: 1_500, 2: 1_000, 4095: 3},
        {0: 7},
        {},
    ],
)
def test_never_above_best_fit(histogram):
    patterns, n = packing.plan_sequences(histogram)
    assert sequences(patterns, histogram, 4096) == n <= best_fit(histogram, 4096)


def test_search_finds_what_best_fit_misses():
    histogram = {1366: 100, 1365: 300}
    patterns, n = packing.plan_sequences(histogram)
    assert sequences(patterns, histogram, 4096) == n == 134 < best_fit(histogram, 4096)


def test_small_cases_are_least():
    rng = random.Random(4)
    least = 0
    for _ in range(150):
        pieces = sorted((rng.randint(1, 12) for _ in range(rng.randint(1, 9))), reverse=True)
        patterns, n = packing.plan_sequences(Counter(pieces), 15)
        assert sequences(patterns, Counter(pieces), 15) == n
        least += n == fewest(pieces, 15)
    assert least == 150


def test_best_fit_of_groups_equals_piece_by_piece():
    rng = random.Random(5)
    for _ in range(300):
        histogram = Counter(rng.randint(1, rng.choice([5, 30, 100])) for _ in range(rng.randint(1, 80)))
        patterns = packing.best_fit_decreasing(histogram, 100)
        assert sequences(patterns, histogram, 100) == best_fit(histogram, 100)


def test_dominance():
    assert packing.dominates([5, 3], [4, 1, 3]) and packing.dominates([4], [2, 2])
    assert not packing.dominates([2, 2], [4]) and not packing.dominates([5], [5, 1])
    counts = {6: 1, 5: 1, 4: 2, 2: 2, 1: 1}
    lengths = sorted(counts, reverse=True)
    found, _ = packing.undominated(10, lengths, counts, 10, 10_000)
    every = {
        tuple(sorted(c, reverse=True))
        for k in range(1, 8)
        for c in itertools.combinations([6, 5, 4, 4, 2, 2, 1], k)
        if sum(c) == 10
    }
    assert found and all(tuple(f) in every for f in found)
    for a, b in itertools.permutations(found, 2):
        assert not packing.dominates(a, b)


def test_budgets_end_the_search(monkeypatch):
    monkeypatch.setattr(packing, "PLAN_NODES", 5)
    histogram = made(6, 900, 1499, 500)
    patterns, n = packing.plan_sequences(histogram, nodes=3)
    assert sequences(patterns, histogram, 4096) == n <= best_fit(histogram, 4096)
