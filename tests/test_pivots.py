"""Neighbours by pivots against all distances."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from urlsift.operators import knn as KN
from urlsift.operators import oversample as OS

SCHEMA = "id long, features array<float>, label int"


def rows_of(points, first=0):
    return [(first + i, [float(x) for x in p], i % 3) for i, p in enumerate(points)]


def brute(queries, refs, k, power):
    out = {}
    for i, q, _ in queries:
        gaps = [(float((np.abs(np.float32(q).astype(float) - np.float32(r).astype(float)) ** power).sum()) ** (1 / power), j) for j, r, _ in refs]
        out[i] = [j for _, j in sorted(gaps)[:k]]
    return out


def points(kind, n, width, seed):
    rng = np.random.default_rng(seed)
    if kind == "clusters":
        return rng.normal(size=(12, width))[rng.integers(0, 12, n)] * 20 + rng.normal(size=(n, width)) * 0.3
    if kind == "grid":
        return rng.integers(0, 3, (n, width))
    return np.zeros((n, width))


@pytest.mark.parametrize(("kind", "metric", "p", "power"), [("clusters", "euclidean", 1, 2), ("clusters", "manhattan", 1, 1), ("grid", "minkowski", 3, 3), ("same", "euclidean", 1, 2)])
def test_equal_to_all_distances(spark, kind, metric, p, power):
    refs, queries = rows_of(points(kind, 900, 5, 1)), rows_of(points(kind, 70, 5, 2), 5000)
    both = [spark.createDataFrame(x, SCHEMA).repartition(3) for x in (queries, refs)]
    found = KN.nearest(*both, keys=["id"], k=7, metric=metric, p=p, bound=0, block_rows=40, scored=True).collect()
    assert {r.id: [n.ref_id for n in r.neighbours] for r in found} == brute(queries, refs, 7, power)
    if kind == "clusters":
        assert sum(r.scored for r in found) < 0.5 * len(refs) * len(queries)


def test_fewer_references_than_asked_for(spark):
    refs, queries = rows_of(points("clusters", 5, 3, 1)), rows_of(points("clusters", 4, 3, 2), 50)
    found = KN.nearest(spark.createDataFrame(queries, SCHEMA), spark.createDataFrame(refs, SCHEMA), keys=["id"], k=9, bound=0, block_rows=2).collect()
    assert {r.id: [n.ref_id for n in r.neighbours] for r in found} == brute(queries, refs, 9, 2)


@pytest.mark.parametrize("bound", [0, 1 << 20])
def test_vectors_that_are_none(spark, bound):
    refs = [(1, [0.0, 0.0], 0), (2, None, 1), (3, [5.0, 5.0], 1), (4, [float("nan"), 0.0], 1), (5, [None, 1.0], 0)]
    queries = [(10, [5.0, 5.0], None), (11, None, None), (12, [0.0, float("inf")], None), (13, [0.0, 1.0], None)]
    found = KN.nearest(spark.createDataFrame(queries, SCHEMA), spark.createDataFrame(refs, SCHEMA), keys=["id"], k=2, bound=bound, block_rows=1)
    got = {r.id: [(n.ref_id, n.label) for n in r.neighbours] for r in found.collect()}
    assert got == {10: [(3, 1), (1, 0)], 11: [], 12: [], 13: [(1, 0), (3, 1)]}
    votes = {r.id: (r.v, r.s) for r in found.select("id", KN.vote(F.col("neighbours")).alias("v"), KN.phishing_share(F.col("neighbours")).alias("s")).collect()}
    assert votes[11] == (None, None) and votes[10] == (1, 0.5)


def test_unequal_lengths_are_errors(spark):
    even, odd = spark.createDataFrame([(1, [0.0, 0.0], 0)], SCHEMA), spark.createDataFrame([(1, [0.0, 0.0], 0), (2, [0.0], 0)], SCHEMA)
    with pytest.raises(ValueError, match="1 to 2 components"):
        KN.nearest(even, odd, keys=["id"])
    with pytest.raises(Exception, match="a query vector has 1 components"):
        KN.nearest(odd, even, keys=["id"], k=1).collect()


def test_oversampling_passes_over_missing_vectors(spark):
    rows = [(i, [float(i), 1.0], 0) for i in range(12)] + [(100 + i, [float(i), 2.0], 1) for i in range(4)] + [(200, None, 1)]
    out = OS.smote(spark.createDataFrame(rows, SCHEMA), key="id", k=2).collect()
    new = [r for r in out if r.id is None]
    assert len(new) == 7 and all(100 <= r.origin < 104 and 100 <= r.partner < 104 and None not in r.features for r in new)
