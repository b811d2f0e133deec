"""Evaluation of labels and scores; class 0 is the positive class throughout."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urlsift import contract as C
from urlsift.functions.stats import safe_ratio
from urlsift.operators.ordering import ROWS_PER_RANGE, range_count
from urlsift.runtime import small, written


def threshold_label(score: Column, threshold: float) -> Column:
    return F.when(score >= threshold, C.PHISHING).otherwise(C.LEGITIMATE)


def confusion_counts(truth: Column, predicted: Column) -> list[Column]:
    """tp, fn, fp, tn as aggregates."""
    def cell(t, p, name):
        return F.count_if((truth == t) & (predicted == p)).alias(name)

    return [cell(0, 0, "tp"), cell(0, 1, "fn"), cell(1, 0, "fp"), cell(1, 1, "tn")]


def rates(counted: DataFrame, baseline: float | None = C.MAJORITY_ACCURACY) -> DataFrame:
    """Rates from tp, fn, fp, tn; a rate with an empty denominator is 0.

    Without a given baseline accuracy the share of the larger class is used.
    """
    tp, fn, fp, tn = (F.col(c) for c in ("tp", "fn", "fp", "tn"))
    n = tp + fn + fp + tn
    base = safe_ratio(F.greatest(tp + fn, fp + tn), n) if baseline is None else F.lit(baseline)
    first = counted.withColumns(
        {
            "accuracy": safe_ratio(tp + tn, n),
            "baseline_accuracy": base,
            "phishing_precision": safe_ratio(tp, tp + fp),
            "phishing_recall": safe_ratio(tp, tp + fn),
            "legitimate_precision": safe_ratio(tn, tn + fn),
            "legitimate_recall": safe_ratio(tn, tn + fp),
            "support_phishing": tp + fn,
            "support_legitimate": fp + tn,
            "missed_share": safe_ratio(fn, tp + fn),
        }
    )

    def f1(side):
        p, r = F.col(f"{side}_precision"), F.col(f"{side}_recall")
        return safe_ratio(2 * p * r, p + r)

    return first.withColumns(
        {
            "phishing_f1": f1("phishing"),
            "legitimate_f1": f1("legitimate"),
            "lift_over_baseline": F.col("accuracy") - F.col("baseline_accuracy"),
        }
    )


def model_metrics(df: DataFrame, truth: str, models: Sequence[str], by: Sequence[str] = (),
                  baseline: float | None = C.MAJORITY_ACCURACY) -> DataFrame:
    """One row per model (and group): confusion counts and rates, one pass over the rows."""
    aggs = []
    for m in models:
        cells = confusion_counts(F.col(truth), F.col(f"{m}_pred"))
        aggs.append(F.struct(F.lit(m).alias("model"), *cells).alias(m))
    wide = df.groupBy(*by).agg(*aggs)
    rows = wide.select(*by, F.explode(F.array(*[F.col(m) for m in models])).alias("r"))
    return rates(rows.select(*by, "r.*"), baseline)


def _threshold_index(score: Column, n_points: int) -> Column:
    """Largest i with i * step <= score, exact for scores that sit on a threshold."""
    step = 1.0 / (n_points - 1)
    guess = F.floor(score / step).cast("int")

    def at(i):
        return F.when(i == n_points - 1, F.lit(1.0)).otherwise(i.cast("double") * F.lit(step))

    return F.least(
        F.when(at(guess + 1) <= score, guess + 1).when(at(guess) > score, guess - 1).otherwise(guess),
        F.lit(n_points - 1),
    )


def precision_recall_curve(df: DataFrame, truth: str, score: str, n_points: int = 101) -> DataFrame:
    """Precision and recall at evenly spaced thresholds from 0 to 1.

    Each row is counted once in the bucket of the highest threshold it reaches; the
    curve is a running sum over the buckets, whose number is ``n_points``.
    """
    spark = df.sparkSession
    counted = df.groupBy(_threshold_index(F.col(score), n_points).alias("i")).agg(
        F.count_if(F.col(truth) == 0).alias("pos"), F.count_if(F.col(truth) == 1).alias("neg")
    )
    points = spark.range(n_points).select(F.col("id").cast("int").alias("i"))
    down = Window.partitionBy(F.lit(0)).orderBy(F.col("i").desc())
    whole = Window.partitionBy(F.lit(0))
    # rows below every threshold are kept for the recall denominator
    merged = points.join(counted, "i", "full_outer").fillna(0, ["pos", "neg"])
    summed = merged.select(
        "i",
        F.sum("pos").over(down).alias("tp"), F.sum("neg").over(down).alias("fp"),
        F.sum("pos").over(whole).alias("n_pos"),
    ).filter("i >= 0")
    step = 1.0 / (n_points - 1)
    return summed.select(
        F.when(F.col("i") == n_points - 1, F.lit(1.0)).otherwise(F.col("i") * F.lit(step)).alias("threshold"),
        safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        safe_ratio(F.col("tp"), F.col("n_pos")).alias("recall"),
    )


def average_precision(df: DataFrame, truth: str, score: str, tie: Sequence[str], **options) -> DataFrame:
    """Mean over positives of the precision at their rank, by score downwards.

    Equal scores are ordered by the tie columns. One row; 0 without positives.
    """
    slim = df.select(F.lit(0).alias("model"), F.col(score).alias("_score"), *tie, (F.col(truth) == 0).cast("int").alias("_pos"))
    return _precision_at_positives(slim, df.count(), tie, **options).agg(
        F.coalesce(F.first("average_precision"), F.lit(0.0)).alias("average_precision")
    )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a range in order (model, range, _pos): the rank of each positive and the positives up to it, within its model and range,
    and at the end of each model the totals."""
    names = ["model", "range", "rank", "tp", "total"]
    here, ranks, found = None, 0, 0

    def out(rank, tp, total):
        cols = [np.full(len(rank), here[0], np.int32), np.full(len(rank), here[1], np.int32), rank, tp, np.full(len(rank), total)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names)

    for batch in batches:
        model, place, pos = (batch.column(i).fill_null(0).to_numpy() for i in range(3))
        cuts = [0, *(np.flatnonzero(np.diff(model)) + 1).tolist(), len(model)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if here != (model[a], place[a]):
                if here is not None:
                    yield out(np.array([ranks]), np.array([found]), True)
                here, ranks, found = (model[a], place[a]), 0, 0
            at = np.flatnonzero(pos[a:b] == 1)
            yield out(ranks + at + 1, found + 1 + np.arange(len(at)), False)
            ranks, found = ranks + b - a, found + len(at)
    if here is not None:
        yield out(np.array([ranks]), np.array([found]), True)


def _precision_at_positives(slim: DataFrame, n_rows: int, tie: Sequence[str], rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``slim``: model (a number), _score, the tie columns and _pos; ``n_rows`` rows, all models in one order.

    One shuffle brings the rows into ranges of the order; of these only the positives and the totals are written. The totals
    before a range complete its ranks.
    """
    order = ["model", F.col("_score").desc(), *tie]
    n = range_count(n_rows, rows_per_range)
    ranged = slim.repartitionByRange(n, *order) if n > 1 else slim.coalesce(1)
    rows = ranged.sortWithinPartitions(*order).select("model", F.spark_partition_id().alias("range"), "_pos")
    counted = written(rows.mapInArrow(_counted, "model int, range int, rank long, tp long, total boolean"), "positives")
    before = Window.partitionBy("model").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.filter("total").select(
        "model", "range", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"before_{c}") for c in ("rank", "tp")]
    )
    ranked = counted.filter("not total").join(small(offsets), ["model", "range"])
    precision = F.avg((F.col("before_tp") + F.col("tp")) / (F.col("before_rank") + F.col("rank")))
    return ranked.groupBy("model").agg(precision.alias("average_precision"))


def average_precision_table(df: DataFrame, truth: str, models: Sequence[str], tie: Sequence[str],
                            **options) -> DataFrame:
    """One row per model, all ranked in one pass."""
    slim = df.select(
        *tie, (F.col(truth) == 0).cast("int").alias("_pos"),
        F.posexplode(F.array(*[F.col(f"{m}_score").cast("double") for m in models])).alias("model", "_score"),
    )
    found = _precision_at_positives(slim, df.count() * len(models), tie, **options)
    every = df.sparkSession.createDataFrame(list(enumerate(models)), "place int, name string")
    named = every.join(found, F.col("place") == F.col("model"), "left").select(F.col("name").alias("model"), "average_precision")
    return named.fillna(0.0, ["average_precision"])


def disagreement(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Share of rows on which two label columns differ, per named pair; 0 when empty."""
    aggs = [
        F.coalesce(F.avg((~F.col(a).eqNullSafe(F.col(b))).cast("double")), F.lit(0.0)).alias(name)
        for name, (a, b) in pairs.items()
    ]
    return df.agg(*aggs).unpivot([], list(pairs), "family", "rate")


def class_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per label, from one confusion count."""
    counted = df.agg(*confusion_counts(F.col(truth), F.col(predicted)))
    rated = rates(counted, None)
    sides = F.array(
        *[
            F.struct(
                F.lit(label).alias("label"), F.col(f"{side}_precision").alias("precision"),
                F.col(f"{side}_recall").alias("recall"), F.col(f"{side}_f1").alias("f1"),
                F.col(f"support_{side}").alias("support"),
            )
            for label, side in ((0, "phishing"), (1, "legitimate"))
        ]
    )
    return rated.select(F.explode(sides).alias("s")).select("s.*")


def weighted_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Support-weighted precision, recall and F1."""
    report = class_report(df, truth, predicted)
    total = F.sum("support")
    return report.agg(
        *[
            safe_ratio(F.sum(F.col(m) * F.col("support")), total).alias(f"weighted_{m}")
            for m in ("precision", "recall", "f1")
        ]
    )


def compare_profiles(metrics: DataFrame, measures: Sequence[str], profiles: Sequence[str]) -> DataFrame:
    """Metrics of each model with one column per profile and measure."""
    aggs = [F.first(m).alias(m) for m in measures]
    return metrics.groupBy("model").pivot("profile", list(profiles)).agg(*aggs)
