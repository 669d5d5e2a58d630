"""Best-fit packing plans against exhaustive search on small cases, and against best fit alone."""

import functools
import random
from collections import Counter

from tidewater.llm import packing


def sequences(plan):
    return sum(many for _, many in plan)


def fewest(pieces, capacity):
    """Exhaustive: the least number of sequences."""

    @functools.lru_cache(None)
    def go(left, bins):
        if not left:
            return len(bins)
        best, seen = None, set()
        for i, free in enumerate(bins):
            if free >= left[0] and free not in seen:
                seen.add(free)
                n = go(left[1:], tuple(sorted([*bins[:i], free - left[0], *bins[i + 1 :]])))
                best = n if best is None else min(best, n)
        n = go(left[1:], tuple(sorted([*bins, capacity - left[0]])))
        return n if best is None else min(best, n)

    return go(tuple(sorted(pieces, reverse=True)), ())


def checked_plan(counts, capacity):
    plan = packing.plan_sequences(list(counts), list(counts.values()), capacity)
    placed = Counter()
    for used, many in plan:
        assert sum(used) <= capacity and many > 0
        for size in used:
            placed[size] += many
    assert placed == Counter({k: v for k, v in counts.items() if v})
    return plan


def test_small_cases_against_exhaustive_search():
    rng, right = random.Random(5), 0
    for _ in range(60):
        pieces = [rng.randint(1, 16) for _ in range(rng.randint(1, 9))]
        got, best = sequences(checked_plan(Counter(pieces), 16)), fewest(pieces, 16)
        assert got <= best + 1
        right += got == best
    assert right >= 57


def test_not_worse_than_best_fit_alone(monkeypatch):
    rng = random.Random(6)
    for low, high, n in ((1, 64, 500), (20, 50, 400), (1, 10, 50), (33, 64, 30)):
        counts = Counter(min(64, max(low, int(rng.gauss((low + high) / 2, high / 4)))) for _ in range(n))
        got = sequences(checked_plan(counts, 64))
        monkeypatch.setattr(packing, "SHARES", (0.0,))
        alone = sequences(checked_plan(counts, 64))
        monkeypatch.undo()
        assert -(-sum(k * v for k, v in counts.items()) // 64) <= got <= alone


def test_patterns_place_pieces_where_they_fit(monkeypatch):
    """Two lengths that fill a sequence together: the patterns alone reach the token bound."""
    monkeypatch.setattr(packing, "SHARES", (1.0,))
    seen = {}
    real = packing._realised
    monkeypatch.setattr(packing, "_realised", lambda *a: seen.setdefault("bins", real(*a)))
    plan = checked_plan(Counter({40: 1000, 24: 1000, 32: 500}), 64)
    assert sequences(plan) == 1250
    assert sum(len(used) * many for _, used, many in seen["bins"]) > 2000


def test_configurations_cover_every_demand():
    import numpy as np

    sizes, demand = np.array([5, 9, 17, 30, 41]), np.array([70.0, 30.0, 55.0, 10.0, 25.0])
    bought = packing.solve_configurations(sizes, demand, 64)
    assert all((c * sizes).sum() <= 64 for c, _ in bought)
    assert (sum(c * x for c, x in bought) >= demand - 1e-6).all()
