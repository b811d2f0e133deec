"""Short cascades are written out step by step, with the fold's results."""

from types import SimpleNamespace

from pyspark.sql import functions as F

from catalog.fit_queries import LINE_SPEC
from urlsift.operators import fit as FT


def test_steps_equal_the_fold(spark, monkeypatch):
    modes = [
        FT.Modes(1.0, 2, (("0.0|", 1.0), ("1.0|", 0.0)), None),
        FT.Modes(0.0, 2, (("0.0|1.0|", 1.0), ("1.0|0.0|", 0.0)), None),
        FT.Modes(0.0, 1, (("1.0|0.0|0.0|", 1.0),), None),
    ]
    stats = SimpleNamespace(spec=LINE_SPEC, cascade=tuple(modes))
    rows = spark.range(500).select("id", F.when(F.col("id") % 9 > 0, (F.col("id") % 4 == 0).cast("double")).alias("is_return"), *[
        F.when(F.col("id") % m > m // 3, (F.col("id") % 2).cast("double")).alias(c) for c, m in (("is_open", 7), ("is_large", 11), ("is_deal", 13))])
    steps = FT.replay_cascade(rows, stats, count_missed=True)
    assert "aggregate(" not in steps._jdf.queryExecution().optimizedPlan().toString()
    found = sorted(steps.collect())
    monkeypatch.setattr(FT, "UNROLLED_STEPS", 0)
    assert found == sorted(FT.replay_cascade(rows, stats, count_missed=True).collect())
