"""Nearest rows of tiles: equal to all distances, in bounded memory, with few exact distances of other powers."""

import tracemalloc

import numpy as np
import pytest

from urlsift.operators import distances as D


def values(kind, size, rng):
    return {"normal": rng.normal(size=size), "grid": rng.integers(0, 3, size), "same": np.ones(size), "huge": rng.normal(size=size) * 1e25,
            "tiny": rng.normal(size=size) * 1e-15, "far": 1000 + rng.normal(size=size) * 1e-2}[kind].astype(np.float32)


@pytest.mark.parametrize("kind", ["normal", "grid", "same", "huge", "tiny", "far"])
@pytest.mark.parametrize("power", [1, 2, 3, 5])
def test_equal_to_all_distances(kind, power):
    rng = np.random.default_rng(1)
    for n, m, width, k in ((20, 6000, 5, 7), (5, 3, 4, 9)):
        q, ref, ids = values(kind, (n, width), rng), values(kind, (m, width), rng), rng.permutation(m)
        found, dist = D.nearest_rows(q, ref, ids, k, power)
        for i in range(n):
            every = D.direct(q[i].astype(float), ref.astype(float), power)
            order = np.lexsort((ids, every))[:k]
            assert found[i].tolist() == order.tolist() and dist[i].tolist() == every[order].tolist()


def test_memory_does_not_grow_with_the_references():
    rng = np.random.default_rng(2)
    q, ref = values("normal", (512, 4), rng), values("normal", (120_000, 4), rng)
    tracemalloc.start()
    D.nearest_rows(q, ref, np.arange(len(ref)), 6, 2)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 60 << 20


def test_other_powers_measure_few_pairs(monkeypatch):
    measured, whole = [], D.direct
    monkeypatch.setattr(D, "direct", lambda q, r, power: measured.append(np.broadcast(q, r).size // r.shape[-1]) or whole(q, r, power))
    rng = np.random.default_rng(3)
    q, ref = values("normal", (40, 16), rng), values("normal", (20_000, 16), rng)
    D.nearest_rows(q, ref, np.arange(len(ref)), 6, 3)
    assert sum(measured) < 0.2 * len(q) * len(ref)


@pytest.mark.parametrize("kind", ["normal", "grid", "same", "huge", "tiny", "far"])
def test_groups_equal_tiles(kind):
    rng = np.random.default_rng(4)
    for m, k in ((D.GROUPS, 3), (10_000, 20), (1_001, 25)):
        q, ref, ids = values(kind, (130, 8), rng), values(kind, (m, 8), rng), rng.permutation(m)
        for have, want in zip(D._by_groups(q, ref, ids, k, max(D.GROUPS, 8 * k)), D._by_tiles(q, ref, ids, k, 2), strict=True):
            assert (have == want).all()


def test_few_references_are_measured_for_each_query(monkeypatch):
    measured, whole = [], D.direct
    monkeypatch.setattr(D, "direct", lambda q, r, power: measured.append(len(q)) or whole(q, r, power))
    rng = np.random.default_rng(5)
    q, ref = values("normal", (512, 8), rng), values("normal", (10_000, 8), rng)
    D.nearest_rows(q, ref, np.arange(len(ref)), 20, 2)
    # The k nearest and few more; about 120 by tiles of growing size.
    assert sum(measured) < 30 * len(q)
