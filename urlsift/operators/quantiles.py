"""Exact quantiles with linear interpolation, without holding a column in one task.

The built-in exact percentile keeps every distinct value of a column in one
buffer. That is fine while rows times columns is small, and only then is it used.
Otherwise the wanted ranks are found digit by digit: a scan counts the values by the
leading bits of their ordered form, the next one counts those that share the found
bits by the bits behind them. A scan counts all ranks of all columns at once, a range
of one value ends its search, and no distribution needs more scans than a double has
digits. The result is the same.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SMALL_CELLS = 4_000_000
ACCURACY = 65_536
INSIDE_ROWS = 1_000_000
# Counters of a task; more ranges at a time get fewer digits each.
CELLS = 1 << 21

_LOWEST, _HIGHEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], *,
    small_cells: int = SMALL_CELLS, inside_rows: int = INSIDE_ROWS, accuracy: int = ACCURACY,
) -> dict[str, list[float | None]]:
    """Quantiles of each column over its non-NULL values, in the order of ``probs``.

    ``accuracy`` is the largest number of ranges a range is cut into by a scan. Ranges that hold at most ``inside_rows`` rows
    together are ranked by their values as they are.
    """
    if not cols:
        return {}
    row = df.agg(*[F.count(c).alias(c) for c in cols]).first()
    counts = {c: row[c] for c in cols}
    if sum(counts[c] for c in cols) <= small_cells:
        row = df.agg(*[F.percentile(c, [float(p) for p in probs]).alias(c) for c in cols]).first()
        return {c: list(row[c]) if row[c] is not None else [None] * len(probs) for c in cols}
    return _by_digits(df, [c for c in cols if counts[c]], probs, counts, inside_rows, accuracy) | {
        c: [None] * len(probs) for c in cols if not counts[c]
    }


def _ordered(column: pa.Array) -> np.ndarray:
    """The column's numbers as whole numbers in the same order: NaN last, both zeros alike, NULL left out."""
    values = column.drop_null().to_numpy(zero_copy_only=False) + 0.0
    values[np.isnan(values)] = np.nan
    bits = values.view(np.int64)
    return bits ^ ((bits >> 63) & _HIGHEST)


def _number(key: int) -> float:
    bits = np.array([key], np.int64)
    return float((bits ^ ((bits >> 63) & _HIGHEST)).view(np.float64)[0])


def _counter(ranges: Sequence[tuple[int, int, int]], shift: int, digits: int):
    """Counts, smallest and largest value by the ``digits`` bits above ``shift``, of the values within each (column, low, high)."""
    mask = (1 << digits) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((len(ranges), mask + 1), np.int64)
        least, most = np.empty_like(n), np.empty_like(n)
        for batch in batches:
            sorted_columns = {}
            for i, (c, low, high) in enumerate(ranges):
                if c not in sorted_columns:
                    sorted_columns[c] = np.sort(_ordered(batch.column(c)))
                keys = sorted_columns[c]
                keys = keys[np.searchsorted(keys, low) : np.searchsorted(keys, high, "right")]
                if not len(keys):
                    continue
                digit = (keys >> shift) & mask
                starts = np.append(0, np.flatnonzero(np.diff(digit)) + 1)
                ends = np.append(starts[1:], len(keys))
                at, first, last = digit[starts], keys[starts], keys[ends - 1]
                new = n[i, at] == 0
                least[i, at] = np.where(new, first, np.minimum(least[i, at], first))
                most[i, at] = np.where(new, last, np.maximum(most[i, at], last))
                n[i, at] += ends - starts
        i, at = np.nonzero(n)
        found = [i.astype(np.int32), at.astype(np.int32), n[i, at], least[i, at], most[i, at]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["i", "digit", "n", "least", "most"])

    return run


def _values(ranges: Sequence[tuple[int, int, int]]):
    """Counted values within each (column, low, high), by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (c, low, high) in enumerate(ranges):
                keys = _ordered(batch.column(c))
                keys, n = np.unique(keys[(keys >= low) & (keys <= high)], return_counts=True)
                cols = [np.full(len(keys), i, np.int32), keys, n.astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["i", "least", "n"])

    return run


def _by_digits(df, cols, probs, counts, inside_rows, accuracy):
    spark = df.sparkSession
    numbers = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    ranks = {(i, e(p * (counts[c] - 1))) for i, c in enumerate(cols) for p in probs for e in (math.floor, math.ceil)}
    # of each zero-based rank: the range of ordered numbers that holds it, rows below, rows inside
    open_ = {t: (_LOWEST, _HIGHEST, 0, counts[cols[t[0]]]) for t in ranks}
    done, left = {}, 64
    while open_:
        ranges = sorted({(t[0], low, high) for t, (low, high, _, _) in open_.items()})
        place = {r: i for i, r in enumerate(ranges)}
        inside = {(t[0], low, high): n for t, (low, high, _, n) in open_.items()}
        if sum(inside.values()) <= inside_rows:
            counted = numbers.mapInArrow(_values(ranges), "i int, least long, n long").groupBy("i", "least").agg(F.sum("n").alias("n"))
            counted = counted.withColumn("most", F.col("least"))
        else:
            digits = min(left, max(1, min(accuracy, CELLS // len(ranges)).bit_length() - 1))
            left -= digits
            counted = numbers.mapInArrow(_counter(ranges, left, digits), "i int, digit int, n long, least long, most long")
            counted = counted.groupBy("i", "digit").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))
        # a range's digits number at most ``accuracy``, its values ``inside_rows``
        before = Window.partitionBy("i").orderBy("least").rowsBetween(Window.unboundedPreceding, 0)
        wanted = [(place[t[0], low, high], *t, t[1] - below) for t, (low, high, below, _) in open_.items()]
        asked = spark.createDataFrame(wanted, "i int, col int, rank long, at long")
        ranked = counted.withColumn("upto", F.sum("n").over(before)).join(F.broadcast(asked), "i")
        rows = ranked.filter((F.col("at") < F.col("upto")) & (F.col("at") >= F.col("upto") - F.col("n"))).collect()
        if len(rows) != len(open_):
            raise RuntimeError("the rows changed between two scans")
        for r in rows:
            t = (r["col"], r["rank"])
            below = open_[t][2] + r["upto"] - r["n"]
            if r["least"] == r["most"]:
                done[t] = _number(r["least"])
                del open_[t]
            else:
                open_[t] = (r["least"], r["most"], below, r["n"])
    out = {}
    for i, c in enumerate(cols):
        out[c] = []
        for p in probs:
            rank = p * (counts[c] - 1)
            a, b = done[i, math.floor(rank)], done[i, math.ceil(rank)]
            out[c].append(a + (b - a) * (rank - math.floor(rank)))
    return out
