"""Quantiles digit by digit, cascades filled in place, and rounding without decimal text."""

import math
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from catalog.fit_queries import LINE_SPEC
from urlsift.functions.stats import rounded
from urlsift.operators import fit as FT
from urlsift.operators import quantiles as Q


def _numbers():
    rng = random.Random(5)
    odd = [0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, 1.0, math.nextafter(1.0, 2.0), -1.0]
    wide = [rng.choice((-1, 1)) * 10.0 ** rng.uniform(-30, 30) for _ in range(700)]
    close = [1.0 + i * 2.0**-52 for i in range(300)]
    return odd + wide + close


@pytest.mark.parametrize("options", [{"inside_rows": 0}, {"inside_rows": 0, "accuracy": 40}, {"inside_rows": 200}, {}])
def test_ranks_are_found_without_sketches(spark, monkeypatch, options):
    monkeypatch.setattr(Q.F, "percentile_approx", None)
    values = _numbers()
    df = spark.createDataFrame([(v, 7.0, None if i % 3 else float(i)) for i, v in enumerate(values)], "a double, b double, c double").repartition(5)
    probs = [i / (len(values) - 1) for i in range(0, len(values), 37)] + [1.0]
    found = Q.exact_quantiles(df, ["a", "b", "c"], probs, small_cells=0, **options)
    want = sorted(values)
    assert found["a"] == pytest.approx([want[round(p * (len(want) - 1))] for p in probs], rel=1e-9, abs=0)
    assert found["b"] == [7.0] * len(probs)
    few = [float(i) for i in range(0, len(values), 3)]
    assert found["c"] == pytest.approx([few[math.floor(p * (len(few) - 1))] + 3 * (p * (len(few) - 1) % 1) for p in probs])


def test_nan_and_infinity_have_places(spark):
    df = spark.createDataFrame([(v,) for v in (math.nan, -math.inf, math.inf, 1.0, -2.0)], "a double")
    found = Q.exact_quantiles(df, ["a"], [0.25, 0.5, 1.0], small_cells=0, inside_rows=0)["a"]
    assert found[:2] == [-2.0, 1.0] and math.isnan(found[2])


def test_short_cascades_are_filled_in_place(spark, monkeypatch):
    modes = (
        FT.Modes(1.0, 2, (("0.0|", 1.0), ("1.0|", 0.0)), None),
        FT.Modes(0.0, 2, (("0.0|1.0|", 1.0), ("1.0|0.0|", 0.0)), None),
        FT.Modes(0.0, 2, (("1.0|0.0|0.0|", 1.0), ("0.0|1.0|1.0|", 2.0)), None),
    )
    stats = SimpleNamespace(spec=LINE_SPEC, cascade=modes)
    rows = spark.range(500).select("id", F.when(F.col("id") % 9 > 0, (F.col("id") % 4 == 0).cast("double")).alias("is_return"), *[
        F.when(F.col("id") % m > m // 3, (F.col("id") % 2).cast("double")).alias(c) for c, m in (("is_open", 7), ("is_large", 11), ("is_deal", 13))])
    filled = FT.replay_cascade(rows, stats)
    assert "split(" not in filled._jdf.queryExecution().optimizedPlan().toString()
    found = sorted(tuple(r) for r in filled.fillna(-1.0).collect())
    monkeypatch.setattr(FT, "UNROLLED_STEPS", 0)
    assert found == sorted(tuple(r) for r in FT.replay_cascade(rows, stats).fillna(-1.0).collect())


def test_rounding_equals_the_built_in(spark):
    rng = random.Random(3)
    values = [None, math.nan, math.inf, -math.inf, 0.0, -0.0, -0.00004, 0.00005, -0.00005, 1.00005, 2.67495, 1e15 + 0.3, 1e300, -1e300, 99999.99995]
    values += [round(rng.uniform(-5, 5), 5) for _ in range(2000)] + [rng.gauss(0, 1) * 10 ** rng.randint(-6, 9) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    both = rounded(df.select("v", F.round("v", 4).alias("want"), F.col("v").alias("got"), (-F.col("v")).alias("other")), ["got", "other"], 4)
    assert both.columns == ["v", "want", "got", "other"]
    for r in both.collect():
        assert repr(r["want"]) == repr(r["got"]), r
