"""Feature selection scores from class sums; only per-class sums leave the cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsift import contract as C
from urlsift.operators.fit import pooled, vector_moments


def chi2_scores(df: DataFrame, cols: Sequence[str], label: str = C.TARGET) -> DataFrame:
    """Chi-square of each non-negative column: observed class sums against the class share
    of the total."""
    groups = vector_moments(df, cols, label)
    n = sum(g["n"] for g in groups.values())
    rows = []
    for i, c in enumerate(cols):
        sums = {y: g["mean"][i] * g["n"] for y, g in groups.items()}
        total = sum(sums.values())
        score = 0.0
        for y, g in groups.items():
            expected = total * g["n"] / n
            score += (sums[y] - expected) ** 2 / expected if expected else 0.0
        rows.append((c, score if total else None))
    return df.sparkSession.createDataFrame(rows, "feature string, score double")


def anova_f_scores(df: DataFrame, cols: Sequence[str], label: str = C.TARGET) -> DataFrame:
    """One-way F statistic of each column between the classes."""
    groups = vector_moments(df, cols, label)
    total = pooled(groups)
    between_df, within_df = len(groups) - 1, total["n"] - len(groups)
    rows = []
    for i, c in enumerate(cols):
        within = sum(g["ss"][i] for g in groups.values())
        between = sum(g["n"] * (g["mean"][i] - total["mean"][i]) ** 2 for g in groups.values())
        score = (between / between_df) / (within / within_df) if within > 0 else None
        rows.append((c, score))
    return df.sparkSession.createDataFrame(rows, "feature string, score double")


def k_best(scores: DataFrame, k: int) -> DataFrame:
    """The k features with the largest scores; equal scores in name order."""
    return scores.filter(F.col("score").isNotNull()).orderBy(F.desc("score"), "feature").limit(k)


def select_features(df: DataFrame, binary: Sequence[str], numeric: Sequence[str], label: str = C.TARGET,
                    k_binary: int = 20, k_numeric: int = 15) -> DataFrame:
    """Sorted union of the best two-valued columns by chi-square and numerics by F."""
    by_chi2 = k_best(chi2_scores(df, binary, label), k_binary).select("feature")
    by_f = k_best(anova_f_scores(df, numeric, label), k_numeric).select("feature")
    return by_chi2.union(by_f).distinct().orderBy("feature")
