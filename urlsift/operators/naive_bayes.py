"""Gaussian naive Bayes: one aggregation to fit, Arrow batches of the features to score."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urlsift.operators.fit import pooled, vector_moments

# Floor of a zero deviation, share of the largest variance added by
# the smoothed variant.
MIN_STD = 1e-10
SMOOTHING = 1e-9


@dataclass(frozen=True)
class NaiveBayes:
    """Per class 0 and 1: log prior, and mean and deviation per feature."""

    features: tuple[str, ...]
    log_prior: tuple[float, float]
    mean: tuple[tuple[float, ...], tuple[float, ...]]
    std: tuple[tuple[float, ...], tuple[float, ...]]

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (k, f, self.mean[k][i], self.std[k][i], self.log_prior[k])
            for k in (0, 1) for i, f in enumerate(self.features)
        ]
        return spark.createDataFrame(
            rows, "label int, feature string, mean double, std double, log_prior double"
        )


def _value(c: str) -> Column:
    return F.col(c).cast("float").cast("double")


def fit_naive_bayes(
    df: DataFrame, features: Sequence[str], label: str = "label", smoothed: bool = False
) -> NaiveBayes:
    """Fit over all rows in one pass; one row per class comes back.

    The plain variant uses the sample deviation with a floor; the smoothed one the
    population variance plus a share of the largest variance of any feature.
    """
    groups = {
        k: g for k, g in vector_moments(df, [_value(c) for c in features], label).items() if k in (0, 1)
    }
    if 0 not in groups:
        raise ValueError("no row of class 0: the model could not score it")
    total = pooled(groups)
    extra = SMOOTHING * max(total["ss"]) / total["n"] if smoothed else 0.0
    prior, mean, std = [], [], []
    for k in (0, 1):
        g = groups.get(k)
        if g is None:
            prior.append(-math.inf)
            mean.append(tuple(0.0 for _ in features))
            std.append(tuple(MIN_STD for _ in features))
            continue
        prior.append(math.log(g["n"] / total["n"]))
        mean.append(tuple(g["mean"]))
        if smoothed:
            std.append(tuple(math.sqrt(ss / g["n"] + extra) for ss in g["ss"]))
        else:
            std.append(tuple(math.sqrt(ss / (g["n"] - 1)) if ss > 0 else MIN_STD for ss in g["ss"]))
    return NaiveBayes(tuple(features), tuple(prior), tuple(mean), tuple(std))


def log_density(model: NaiveBayes, k: int, i: int, value: Column) -> Column:
    m, s = model.mean[k][i], model.std[k][i]
    const = -0.5 * (math.log(2.0 * math.pi) + 2.0 * math.log(s))
    z = (value - F.lit(m)) / F.lit(s)
    return F.lit(const) - F.lit(0.5) * z * z


def log_joint(model: NaiveBayes, k: int) -> Column:
    """Log prior plus the log densities of all features.

    The literal terms are folded into one constant; the squares are written as one
    SQL expression, which Catalyst compiles without a chain of Python calls.
    """
    const = model.log_prior[k] - sum(
        0.5 * (math.log(2.0 * math.pi) + 2.0 * math.log(s)) for s in model.std[k]
    )
    squares = " + ".join(
        f"((double(float(`{c}`)) - ({m!r}D)) / {s!r}D) * ((double(float(`{c}`)) - ({m!r}D)) / {s!r}D)"
        for c, m, s in zip(model.features, model.mean[k], model.std[k], strict=True)
    )
    return F.lit(const) - F.lit(0.5) * F.expr(squares)


#: Rows of a batch whose squares are held at a time.
CHUNK = 4_096


def _posteriors(model: NaiveBayes):
    """A column function of all features: class and posterior of class 0, both classes' squares as matrices of a chunk of rows."""
    means, stds = np.array(model.mean), np.array(model.std)
    const = np.array([model.log_prior[k] - sum(0.5 * (math.log(2.0 * math.pi) + 2.0 * math.log(s)) for s in model.std[k]) for k in (0, 1)])

    @F.arrow_udf("struct<label: int, score: double>")
    def of(*columns: pa.Array) -> pa.Array:
        known = np.ones(len(columns[0]), bool)
        for c in columns:
            if c.null_count:
                known &= c.is_valid().to_numpy(zero_copy_only=False)
        joint = np.empty((2, len(known)))
        for a in range(0, len(known), CHUNK):
            part = [c.slice(a, CHUNK) for c in columns]
            x = np.stack([(p.fill_null(0.0) if p.null_count else p).to_numpy(zero_copy_only=False) for p in part]).astype(np.float64)
            for k in (0, 1):
                z = (x - means[k][:, None]) / stds[k][:, None]
                joint[k, a : a + CHUNK] = const[k] - 0.5 * np.einsum("ij,ij->j", z, z)
        with np.errstate(invalid="ignore"):
            e = np.exp(joint - joint.max(axis=0))
            score = e[0] / e.sum(axis=0)
            label = np.where((joint[0] >= joint[1]) | np.isnan(joint[0]), 0, 1)
        label[~known] = 1
        fields = [pa.array(label.astype(np.int32)), pa.array(score, pa.float64(), mask=~known)]
        return pa.StructArray.from_arrays(fields, ["label", "score"])

    return of


def score(df: DataFrame, model: NaiveBayes, prefix: str = "nb") -> DataFrame:
    """Add ``<prefix>_label`` and ``<prefix>_score`` (posterior of class 0).

    A tie goes to class 0. The larger log joint is subtracted before exponentiation. A row without some feature has no score
    and class 1. The features alone go to the workers, in Arrow batches; generated code for this many terms
    is too long to be compiled.
    """
    features = [F.col(f"`{c}`").cast("float") for c in model.features]
    staged = df.withColumn("_nb", _posteriors(model)(*features))
    return staged.withColumns({f"{prefix}_label": F.col("_nb.label"), f"{prefix}_score": F.col("_nb.score")}).drop("_nb")


def product_score(df: DataFrame, model: NaiveBayes, name: str = "product_score") -> DataFrame:
    """Posterior of class 0 by the raw product of densities; NULL where both underflow."""

    def product(k):
        terms = [
            f"{1.0 / (math.sqrt(2.0 * math.pi) * s)!r}D * exp(-pow(double(float(`{c}`)) - ({m!r}D), 2) / {2.0 * s * s!r}D)"
            for c, m, s in zip(model.features, model.mean[k], model.std[k], strict=True)
        ]
        return F.lit(math.exp(model.log_prior[k])) * F.expr(" * ".join(terms))

    staged = df.withColumns({"_p0": product(0), "_p1": product(1)})
    total = F.col("_p0") + F.col("_p1")
    return staged.withColumn(name, F.when(total > 0, F.col("_p0") / total)).drop("_p0", "_p1")


def underflow_audit(df: DataFrame, model: NaiveBayes) -> DataFrame:
    """How many rows lose all evidence when densities are multiplied."""
    return product_score(df, model).agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("product_score").isNull()).alias("underflowed")
    )
