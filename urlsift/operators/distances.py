"""Distances of packed vectors, and the k nearest of one block."""

from __future__ import annotations

import numpy as np
from pyspark.sql import types as T

NEIGHBOURS = T.ArrayType(
    T.StructType(
        [
            T.StructField("ref_id", T.LongType()), T.StructField("label", T.IntegerType()),
            T.StructField("distance", T.DoubleType()),
        ]
    )
)
LISTS = "array<struct<ref_id: bigint, label: int, distance: double>>"
#: References of a tile, cells of a tile's matrix, and pairs measured at a time: memory does not grow with the references.
TILE = 4_096
CELLS = 1 << 20
PAIRS = 1 << 11
#: Groups whose least numbers bound the k-th one, at least.
GROUPS = 128
#: Pairs left for each wanted neighbour, beyond which the references hold so many equal ones that tiles are the better way.
MANY = 16


def direct(q: np.ndarray, r: np.ndarray, power: int) -> np.ndarray:
    """Sum of powered differences over the last axis, without cancellation."""
    gap = np.abs(q - r)
    if power <= 4:
        square = gap * gap if power > 1 else gap
        return (square if power <= 2 else square * gap if power == 3 else square * square).sum(axis=-1)
    return (gap**power).sum(axis=-1)


class Nearest:
    """The k nearest so far of each query by (distance, id): ids, marks and powered distances, infinite where there are fewer.
    References beyond ``cap``, a distance of each query, are passed over."""

    def __init__(self, n: int, k: int, cap: np.ndarray | None = None):
        self.ids, self.marks, self.dist = np.zeros((n, k), np.int64), np.full((n, k), -1, np.int64), np.full((n, k), np.inf)
        self.cap = np.full(n, np.inf) if cap is None else cap

    def bar(self, rows: np.ndarray) -> np.ndarray:
        """The distance beyond which nothing can be among the k nearest of these queries."""
        return np.minimum(self.dist[rows, -1], self.cap[rows])

    def add(self, rows: np.ndarray, ids: np.ndarray, marks: np.ndarray, dist: np.ndarray) -> None:
        """Take in pairs of a query's row and a reference."""
        near = dist <= self.bar(rows)
        if not near.any():
            return
        rows, k = rows[near], self.ids.shape[1]
        touched = np.unique(rows)
        every = np.concatenate([np.repeat(touched, k), rows])
        olds = (self.ids, ids), (self.marks, marks), (self.dist, dist)
        both = [np.concatenate([old[touched].ravel(), new[near]]) for old, new in olds]
        order = np.lexsort((both[0], both[2], every))
        kept = order[np.searchsorted(every[order], touched)[:, None] + np.arange(k)]
        for (old, _), values in zip(olds, both, strict=True):
            old[touched] = values[kept]

    def read(self, rows: np.ndarray, q: np.ndarray, ref: np.ndarray, ids: np.ndarray, marks: np.ndarray, power: int) -> None:
        """Compare the queries in ``rows`` (places in ``q`` and here) with all of ``ref``. The first tiles are small, so that
        the others meet a narrow limit."""
        a = 0
        while a < len(ref):
            b = a + min(TILE, max(TILE // 8, a))
            part = ref[a:b]
            step = max(1, CELLS // len(part))
            for c in range(0, len(rows), step):
                self._tile(rows[c : c + step], q, part, ids[a:b], marks[a:b], power)
            a = b

    def _tile(self, rows, q, ref, ids, marks, power):
        asked, k = q[rows], self.ids.shape[1]
        rough, limit_of, _ = _rough(asked, ref, power)

        def measure(r, c):
            for a in range(0, len(r), PAIRS):
                x, y = r[a : a + PAIRS], c[a : a + PAIRS]
                self.add(rows[x], ids[y], marks[y], direct(asked[x].astype(np.float64), ref[y].astype(np.float64), power))

        few = np.flatnonzero(np.isinf(self.bar(rows)))
        if len(few):
            take = min(k, len(ref))
            first = np.argpartition(rough[few], take - 1, axis=1)[:, :take]
            measure(np.repeat(few, take), first.ravel())
            rough[few[:, None], first] = np.inf
        limit = np.nextafter(limit_of(self.bar(rows)).astype(rough.dtype), rough.dtype.type(np.inf))
        measure(*np.divmod(np.flatnonzero(rough < limit[:, None]), len(ref)))


def _squares(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x, dtype=np.float64)


def _rough(q: np.ndarray, ref: np.ndarray, power: int, more: int = 0):
    """A matrix of numbers for all pairs, and what turns powered distances of the queries into limits: no pair
    within such a distance has a number above its limit, whatever the rounding. By squares, also how far rounding may take a query's
    numbers, and ``more`` infinite columns follow."""
    width = q.shape[1]
    if power == 1:
        top = max(np.abs(q).max(initial=0), np.abs(ref).max(initial=0))
        kind = np.float32 if top * width < 1e37 else np.float64
        q, ref = q.astype(kind, copy=False), ref.astype(kind, copy=False)
        rough, gap, ones = np.empty((len(q), len(ref)), kind), np.empty((min(len(ref), 1024), width), kind), np.ones(width, kind)
        for a in range(0, len(ref), 1024):
            part = ref[a : a + 1024]
            held = gap[: len(part)]
            for i in range(len(q)):
                np.subtract(part, q[i], out=held)
                np.abs(held, out=held)
                np.dot(held, ones, out=rough[i, a : a + 1024])
        return rough, lambda d: d * (1 + (width + 8) * 2.0**-22) + width * 1e-37, None
    # of the squared distance all but the query's own square, by one product; the sum of other powers is at least a share of that of squares
    squares = [_squares(x) for x in (q, ref)]
    largest = squares[1].max()
    kind, unit = (np.float32, 2.0**-22) if max(squares[0].max(), largest) < 1e37 else (np.float64, 2.0**-51)
    left = np.concatenate([-2 * q.astype(kind), np.ones((len(q), 1), kind)], axis=1)
    right = np.concatenate([ref.astype(kind), squares[1][:, None].astype(kind)], axis=1)
    if more:
        right = np.concatenate([right, np.append(np.zeros(width, kind), kind(np.inf))[None].repeat(more, axis=0)])
    rough = left @ right.T
    slack = (width + 8) * unit * (squares[0] + largest) + width * 1e-37

    def limit(d):
        square = d if power == 2 else float(width) ** (1 - 2 / power) * d ** (2 / power) * (1 + 1e-9)
        return square - squares[0] + slack

    return rough, limit, slack


def _by_groups(q: np.ndarray, ref: np.ndarray, ids: np.ndarray, k: int, groups: int):
    """``nearest_rows`` by squares. References fall into ``groups`` groups; at least k have a number up to the k-th of the groups' least ones,
    and only those of up to that, and twice the slack of the rounding, are measured: few more than k."""
    found, dist = np.empty((len(q), k), np.int64), np.empty((len(q), k))
    step = max(1, CELLS // len(ref))
    for a in range(0, len(q), step):
        part = q[a : a + step]
        rough, _, slack = _rough(part, ref, 2, -len(ref) % groups)
        least = rough.reshape(len(part), -1, groups).min(axis=1)
        bound = np.partition(least, k - 1, axis=1)[:, k - 1].astype(np.float64)
        limit = np.nextafter((bound + 2 * slack).astype(rough.dtype), rough.dtype.type(np.inf))
        pairs = np.flatnonzero(rough <= limit[:, None])
        if len(pairs) > max(PAIRS, MANY * k * len(part)):
            # Many equal references.
            found[a : a + step], dist[a : a + step] = _by_tiles(part, ref, ids, k, 2)
            continue
        rows, cols = np.divmod(pairs, rough.shape[1])
        near = np.empty(len(rows))
        for b in range(0, len(rows), PAIRS):
            x, y = rows[b : b + PAIRS], cols[b : b + PAIRS]
            near[b : b + PAIRS] = direct(part[x].astype(np.float64), ref[y].astype(np.float64), 2)
        order = np.lexsort((ids[cols], near, rows))
        kept = order[np.searchsorted(rows, np.arange(len(part)))[:, None] + np.arange(k)]
        found[a : a + step], dist[a : a + step] = cols[kept], near[kept]
    return found, dist


def nearest_rows(q: np.ndarray, ref: np.ndarray, ids: np.ndarray, k: int, power: int):
    """Positions and powered distances of the k nearest references of each query."""
    k, groups = min(k, len(ref)), max(GROUPS, 8 * k)
    few = groups <= len(ref) <= CELLS // 64
    return _by_groups(q, ref, ids, k, groups) if power == 2 and few else _by_tiles(q, ref, ids, k, power)


def _by_tiles(q: np.ndarray, ref: np.ndarray, ids: np.ndarray, k: int, power: int):
    best = Nearest(len(q), k)
    best.read(np.arange(len(q)), q, ref, ids, np.arange(len(ref)), power)
    return best.marks, best.dist


def root(dist: np.ndarray, power: int) -> np.ndarray:
    return np.sqrt(dist) if power == 2 else dist if power == 1 else dist ** (1.0 / power)
