"""Components beyond 2^24 in the exact search."""

import random

import brute
import numpy as np
import pytest
from pyspark.errors import PySparkException

from urlsift.llm import queries, top_k


@pytest.mark.parametrize("spread", [1 << 26, 1 << 29, 1 << 30])
def test_search_of_large_components(spread):
    rng = random.Random(spread)
    rows = [(i, [rng.randint(-spread, spread) for _ in range(5)]) for i in range(200)]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    got_ids, got_scores, _ = top_k.search(ids[:30], x[:30], ids, x, 7, block=16)
    want = brute.top_k(rows, set(range(30)), 7)
    for i, a, b in zip(range(30), got_ids, got_scores, strict=True):
        assert list(zip(a.tolist(), b.tolist(), strict=True)) == want[i]


def test_sums_that_pass_64_bits_on_the_way():
    q, x = np.array([[1 << 31, 1 << 31, 1 << 31]]), np.array([[1 << 32, 1 << 32, -(1 << 32)], [3, 0, 0]])
    with pytest.raises(OverflowError):
        top_k.search(np.array([9]), q, np.array([0]), np.array([[1 << 32, 0, 0]]), 1)
    x[0, 1] = -(1 << 32) + 5
    found = top_k.search(np.array([9]), q, np.array([0, 1]), x, 2)
    assert found[0][0].tolist() == [1, 0] and found[1][0].tolist() == [3 << 31, (5 << 31) - (1 << 63)]


def test_query_of_large_components(spark, folder):
    rng = random.Random(6)
    rows = [(i, [float(rng.randint(-(1 << 24), 1 << 24)) for _ in range(4)]) for i in range(90)] + [(97, [300_000.0, 0.0, 0.0, 0.0]), (98, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = queries.op2_top_k(spark, folder(embeddings=df.repartition(3))).collect()
    want = brute.top_k([(i, [int(64 * x) for x in v]) for i, v in rows if v], {i for i, _ in rows if i % 20 == 0}, 20)
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == want


def test_a_component_that_is_no_long_is_an_error(spark):
    df = spark.createDataFrame([(1, [1e30])], "id long, v array<double>")
    with pytest.raises(PySparkException, match="out of the range"):
        df.select(top_k.quantized(df.v)).collect()
    same = spark.createDataFrame([(1, [1e17, -0.01]), (2, [float("inf")]), (3, [None])], "id long, v array<double>")
    assert [r.q for r in same.select(top_k.quantized(same.v).alias("q")).orderBy("id").collect()] == [[64 * 10**17, -1], None, None]
