"""Moments of few columns by plain aggregates, equal to those of one vector."""

import pytest
from pyspark.sql import functions as F

from urlsift.operators import fit as FT


def test_plain_moments_equal_those_of_a_vector(spark, monkeypatch):
    df = spark.range(700).select((F.col("id") % 5).cast("int").alias("y"), (F.col("id") * 7 % 31 / 3).alias("a"), (F.col("id") % 2).cast("double").alias("b"))
    cells = [(F.col("b") == v).cast("double") for v in (0, 1)]
    with monkeypatch.context() as m:
        m.setattr(FT, "array_to_vector", None)
        plain = [FT.vector_moments(df, ["a", F.col("b")], by, cells) for by in ("y", None)]
    monkeypatch.setattr(FT, "PLAIN_MOMENTS", 0)
    for found, by in zip(plain, ("y", None), strict=True):
        want = FT.vector_moments(df, ["a", F.col("b")], by, cells)
        assert found.keys() == want.keys()
        for g in want:
            assert {k: pytest.approx(v) for k, v in want[g].items()} == found[g]
