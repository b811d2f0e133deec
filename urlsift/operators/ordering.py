"""Positions and running totals in a global order, without one task for the whole order.

Rows are range-partitioned by the whole order, tie columns included, so equal values and
NULLs spread over ranges too, and written; the number of a row's range orders the ranges. Range
totals form a tiny table whose running sums give each range its offset; the rest of the work is
a window inside one range.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urlsift.runtime import small, written

ROWS_PER_RANGE = 250_000
#: Ranges of fewer rows than that are made as long as there are at most so many: each costs a task.
MANY_RANGES = 1_000


def range_count(rows: int, rows_per_range: int) -> int:
    """How many ranges so many rows are dealt to."""
    return max(1, min(math.ceil(rows / rows_per_range), max(MANY_RANGES, math.ceil(rows / ROWS_PER_RANGE))))


def _running(
    df: DataFrame, value: str, columns: Mapping[str, Column], fold, plus, *, tie: Sequence, by: Sequence[str],
    descending: bool, rows_per_range: int,
) -> DataFrame:
    """Add the fold of each expression over all rows up to and including this one; ``plus`` joins the folds of two stretches."""
    lead = df.withColumns({f"_t_{k}": e for k, e in columns.items()})
    order = [F.col(value).desc() if descending else F.col(value).asc(), *tie]
    n = range_count(df.count(), rows_per_range)
    ranged = lead.repartitionByRange(n, *by, *order) if n > 1 else lead.coalesce(1)
    ranged = written(ranged.withColumn("_r", F.spark_partition_id()), "ranges")
    folds = ranged.groupBy(*by, "_r").agg(*[fold(f"_t_{k}").alias(f"_s_{k}") for k in columns])
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = folds.select(*by, "_r", *[fold(f"_s_{k}").over(before).alias(f"_o_{k}") for k in columns])
    inside = Window.partitionBy(*by, "_r").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    renamed = offsets.withColumnsRenamed({c: f"_by_{c}" for c in by}).withColumnRenamed("_r", "_or")
    same = [F.equal_null(ranged[c], renamed[f"_by_{c}"]) for c in by]
    joined = ranged.join(small(renamed), [*same, ranged["_r"] == renamed["_or"]]).drop("_or", *[f"_by_{c}" for c in by])
    found = joined.withColumns({k: plus(F.col(f"_o_{k}"), fold(f"_t_{k}").over(inside)) for k in columns})
    return found.drop("_r", *[f"_{p}_{k}" for k in columns for p in "to"])


def running_totals(
    df: DataFrame, value: str, totals: Mapping[str, Column], *, tie: Sequence = (), by: Sequence[str] = (),
    descending: bool = False, rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add, for each name in ``totals``, the sum of its expression over all rows up to and including this one
    in the order of ``value`` and the ``tie`` columns, within each group of the ``by`` columns.

    NULL values come first in ascending order and last in descending order, as Spark sorts them. The
    whole order should be unique: among equal rows any may come first.
    """
    return _running(df, value, totals, F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + b, tie=tie, by=by, descending=descending, rows_per_range=rows_per_range)


def running_extremes(
    df: DataFrame, value: str, columns: Mapping[str, Column], *, tie: Sequence = (), by: Sequence[str] = (),
    descending: bool = False, rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """The same with the greatest value so far, or the least where the order descends; NULL until there is one."""
    fold, plus = (F.min, F.least) if descending else (F.max, F.greatest)
    return _running(df, value, columns, fold, plus, tie=tie, by=by, descending=descending, rows_per_range=rows_per_range)


def positions(df: DataFrame, value: str, *, tie: Sequence[str] = (), name: str = "position", **options):
    """Add the 1-based position in the order."""
    return running_totals(df, value, {name: F.lit(1)}, tie=tie, **options)


def average_ranks(counted: DataFrame, by: str, value: str, weight: str = "n", *, name: str = "rank", **options) -> DataFrame:
    """Average rank of each distinct value within each group; ``counted`` has one row per group
    and value with its count, so a hot value is a single row."""
    upto = running_totals(counted, value, {"_upto": F.col(weight)}, by=[by], **options)
    return upto.withColumn(name, F.col("_upto") - (F.col(weight) - 1) / 2.0).drop("_upto")
