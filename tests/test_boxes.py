"""Blocks of references and their boxes."""

import numpy as np
import pytest

from urlsift.operators import boxes as B


@pytest.mark.parametrize("kind", ["spread", "few values", "equal"])
def test_tree_and_runs_take_every_row_once(kind):
    rng = np.random.default_rng(3)
    v = {"spread": rng.normal(size=(999, 3)), "few values": rng.integers(0, 2, (999, 3)) ** 9 * 7.5, "equal": np.ones((999, 3))}[kind].astype(np.float32)
    tree = B.tree_of(v, 40)
    cells = tree.place(v)
    assert set(cells.tolist()) <= set(range(tree.cell.max() + 1))
    assert kind == "equal" or len(set(cells.tolist())) > 1
    found = B.runs(v, 64)
    assert sorted(np.concatenate(found).tolist()) == list(range(999)) and max(map(len, found)) <= 64
    assert kind != "equal" or np.concatenate(found).tolist() == list(range(999))


@pytest.mark.parametrize("power", [1, 2, 3])
def test_blocks_left_out_hold_nothing_near(power):
    rng = np.random.default_rng(power)
    refs = rng.random((3000, 2)).astype(np.float32)
    refs[:300] = 0.5
    parts = [refs[at] for at in B.runs(refs, 25)]
    known = B.Ranges(power, np.arange(len(parts)), np.array([len(p) for p in parts]), np.array([p.min(0) for p in parts], np.float64), np.array([p.max(0) for p in parts], np.float64))
    asked = rng.random((4000, 2)).astype(np.float32)
    size = B.stack_rows(2) // B.GROUPS
    asked = asked[np.concatenate(B.runs(asked, size))]
    low, high = B._groups(asked)
    k = 10
    first = known.first(low, high, k)
    assert ((first * known.rows).sum(axis=1) >= k).all()
    away = [(np.abs(asked[:, None, :].astype(float) - p[None].astype(float)) ** power).sum(-1) for p in parts]
    group = np.arange(len(asked)) // size
    limits = np.array([np.partition(np.concatenate([away[b][i] for b in np.flatnonzero(first[group[i]])]), k - 1)[k - 1] for i in range(len(asked))])
    found, need = known.others(low, high, np.maximum.reduceat(limits, np.arange(0, len(asked), size)), k)
    read = first.copy()
    read[:, found] |= need
    for b in range(len(parts)):
        left = ~read[group, b]
        assert (away[b][left].min(axis=1, initial=np.inf) > limits[left]).all()
    assert not (first[:, found] & need).any() and read.mean() < 0.3


def test_queries_are_not_held_against_all_blocks(monkeypatch):
    """Bounds of every query against every block grew with both, and took the time of large tables."""
    rng = np.random.default_rng(5)
    parts = [rng.random((40_000, 2)).astype(np.float32)]
    parts = [parts[0][at] for at in B.runs(parts[0], 20)]
    known = B.Ranges(2, np.arange(len(parts)), np.array([len(p) for p in parts]), np.array([p.min(0) for p in parts], np.float64), np.array([p.max(0) for p in parts], np.float64))
    asked = rng.random((B.QUERY_ROWS, 2)).astype(np.float32) / 8
    low, high = B._groups(asked[np.concatenate(B.runs(asked, B.stack_rows(2) // B.GROUPS))])
    cells = []
    for name in ("least", "most"):
        bound = getattr(B.Ranges, name)
        monkeypatch.setattr(B.Ranges, name, lambda *a, bound=bound: cells.append((out := bound(*a)).size) or out)
    found, need = known.others(low, high, np.full(len(low), 1e-4), 5)
    assert need.any() and sum(cells) < 0.005 * len(asked) * len(parts)
