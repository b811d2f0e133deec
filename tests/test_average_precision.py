"""Average precision over ranges: right beside a plain count, with a bounded number of ranges and one shuffle of the rows."""

import pytest
from pyspark.sql import functions as F

from urlsift.operators import evaluate as E
from urlsift.operators import ordering as O


def plain(rows, place):
    ranked = sorted(rows, key=lambda r: (r[place] is None, -(r[place] or 0), r[0]))
    found, sums = 0, 0.0
    for i, r in enumerate(ranked, 1):
        if r[1] == 0:
            found += 1
            sums += found / i
    return sums / found if found else 0.0


def test_models_of_many_ranges(spark):
    rows = [(i, None if i % 17 == 0 else int(i % 5 > 1), (i * 7 % 50) / 50, None if i % 4 == 0 else (i * 11 % 9) / 9) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, y int, a_score double, b_score double")
    for per in (40, 10_000):
        found = {r.model: r.average_precision for r in E.average_precision_table(df, "y", ["a", "b"], ["id"], rows_per_range=per).collect()}
        assert found == pytest.approx({"a": plain(rows, 2), "b": plain(rows, 3)})
    none = E.average_precision_table(df.filter("y = 1"), "y", ["a", "b"], ["id"])
    assert {r.model: r.average_precision for r in none.collect()} == {"a": 0.0, "b": 0.0}


def test_ranges_do_not_grow_with_small_ranges_asked_for():
    assert O.range_count(600_000, 500) == O.MANY_RANGES and O.range_count(900, 40) == 23 and O.range_count(0, 500) == 1
    assert O.range_count(216_000_000, 500) == O.MANY_RANGES and O.range_count(864_000_000, 250_000) == 3_456


def test_only_positives_are_written(spark, monkeypatch):
    sizes, whole = [], E.written
    monkeypatch.setattr(E, "written", lambda df, name: sizes.append((out := whole(df, name)).count()) or out)
    df = spark.range(2000).select("id", (F.col("id") % 10 > 0).cast("int").alias("y"), (F.col("id") % 7 / 7).alias("s"))
    E.average_precision(df, "y", "s", ["id"], rows_per_range=500).collect()
    assert sizes == [204]
