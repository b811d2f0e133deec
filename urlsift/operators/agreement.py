"""Agreement between two sources of the same features, and the gate built on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsift import constants as K
from urlsift import contract as C
from urlsift.operators.ordering import average_ranks
from urlsift.operators.quantiles import exact_quantiles
from urlsift.runtime import lookup_join, written


def pair_up(expected: DataFrame, actual: DataFrame, on: Sequence[str], features: Sequence[str],
            keep: Sequence[str] = ()) -> DataFrame:
    """Inner join of two feature tables; ``<feature>_expected`` and ``<feature>_actual``."""
    left = expected.select(*on, *keep, *[F.col(c).alias(f"{c}_expected") for c in features])
    right = actual.select(*on, *[F.col(c).alias(f"{c}_actual") for c in features])
    return left.join(right, list(on))


def value_pairs(paired: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Counted (feature, expected, actual) triples where both sides are present.

    Everything the gate measures is a function of these counts. They are combined
    before the shuffle, so a value pair shared by a third of all rows costs one row
    per task.
    """
    items = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"), F.col(f"{c}_expected").cast("double").alias("e"),
                F.col(f"{c}_actual").cast("double").alias("a"),
            )
            for c in features
        ]
    )
    long = paired.select(*by, F.explode(items).alias("p")).select(*by, "p.*")
    present = long.filter(F.col("e").isNotNull() & F.col("a").isNotNull())
    return present.groupBy(*by, "feature", "e", "a").agg(F.count("*").alias("n"))


def agreement_rate(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("feature").agg(
        F.sum("n").alias("n"),
        (F.sum(F.when(F.col("e") == F.col("a"), F.col("n")).otherwise(0)) / F.sum("n")).alias("rate"),
    )


def cohens_kappa(pairs: DataFrame) -> DataFrame:
    """Agreement beyond chance; NULL when chance alone explains everything."""
    left = pairs.groupBy("feature", F.col("e").alias("v")).agg(F.sum("n").alias("ne"))
    right = pairs.groupBy("feature", F.col("a").alias("v")).agg(F.sum("n").alias("na"))
    both = left.join(right, ["feature", "v"]).groupBy("feature").agg(
        F.sum(F.col("ne").cast("double") * F.col("na")).alias("chance")
    )
    joined = agreement_rate(pairs).join(both, "feature", "left")
    pe = F.coalesce("chance", F.lit(0.0)) / (F.col("n").cast("double") * F.col("n"))
    return joined.select(
        "feature", F.when(pe < 1.0, (F.col("rate") - pe) / (1.0 - pe)).alias("kappa")
    )


def spearman(pairs: DataFrame, **options) -> DataFrame:
    """Rank correlation per feature from value counts; NULL when a side is constant.

    Each side's distinct values get their average ranks over range-cut windows; the
    counted pairs look both ranks up. Ranks are centred before they are multiplied.
    """
    stored = written(pairs, "pairs")

    def ranks(side, name):
        counted = stored.groupBy("feature", side).agg(F.sum("n").alias("n"))
        return average_ranks(counted, "feature", side, name=name, **options).drop("n")

    ranked = lookup_join(stored, ranks("e", "_re"), ["feature", "e"])
    ranked = lookup_join(ranked, ranks("a", "_ra"), ["feature", "a"])
    middle = (stored.groupBy("feature").agg(((F.sum("n") + 1) / 2).alias("_mid")))
    x, y = F.col("_re") - F.col("_mid"), F.col("_ra") - F.col("_mid")
    sums = ranked.join(F.broadcast(middle), "feature").groupBy("feature").agg(
        F.sum(F.col("n") * x * y).alias("xy"), F.sum(F.col("n") * x * x).alias("xx"),
        F.sum(F.col("n") * y * y).alias("yy"),
    )
    return sums.select(
        "feature",
        F.when((F.col("xx") > 0) & (F.col("yy") > 0), F.col("xy") / F.sqrt(F.col("xx") * F.col("yy"))).alias("rho"),
    )


def median_errors(paired: DataFrame, features: Sequence[str], **options) -> DataFrame:
    """Exact medians of |actual - expected| and of actual / expected per feature."""
    cols = {}
    for c in features:
        e, a = F.col(f"{c}_expected").cast("double"), F.col(f"{c}_actual").cast("double")
        cols[f"{c}|error"] = F.abs(a - e)
        cols[f"{c}|ratio"] = F.when(e != 0, a / e)
    wide = paired.select(*[v.alias(k) for k, v in cols.items()])
    found = exact_quantiles(wide, list(cols), [0.5], **options)
    rows = [(c, found[f"{c}|error"][0], found[f"{c}|ratio"][0]) for c in features]
    return paired.sparkSession.createDataFrame(
        rows, "feature string, median_abs_error double, median_ratio double"
    )


def score_features(
    paired: DataFrame, binary: Sequence[str], counts: Sequence[str], *,
    binary_gate: float = K.BINARY_GATE, count_gate: float = K.COUNT_GATE,
    minimum: int = K.MIN_COMPARABLE,
) -> DataFrame:
    """One row per feature: metric, value, gate, passed, n and the side measures.

    Two-valued features are judged by the agreement rate, counts by rank
    correlation; too few comparable rows fail. Values are rounded to 4 decimals, the
    gate is applied before rounding.
    """
    features = [*binary, *counts]
    pairs = written(value_pairs(paired, features), "pairs")
    names = paired.sparkSession.createDataFrame(
        [(c, "binary" if c in binary else "count") for c in features], "feature string, kind string"
    )
    joined = names
    for part in (agreement_rate(pairs), cohens_kappa(pairs), spearman(pairs.filter(F.col("feature").isin(list(counts))))):
        joined = joined.join(part, "feature", "left")
    joined = joined.join(median_errors(paired, counts), "feature", "left").fillna(0, ["n"])
    is_binary = F.col("kind") == "binary"
    enough = F.col("n") >= minimum
    value = F.when(is_binary, F.col("rate")).otherwise(F.col("rho"))
    gate = F.when(is_binary, binary_gate).otherwise(count_gate)
    count_side = enough & ~is_binary
    return joined.select(
        "feature", "kind",
        F.when(~enough, "insufficient_data").when(is_binary, "agreement_rate").otherwise("spearman_rho").alias("metric"),
        F.when(enough, F.round(value, 4)).alias("value"),
        F.when(enough, gate).alias("gate"),
        (enough & F.coalesce(value >= gate, F.lit(False))).alias("passed"),
        "n",
        F.when(enough & is_binary, F.round("kappa", 4)).alias("cohens_kappa"),
        F.when(count_side, F.round("median_abs_error", 4)).alias("median_abs_error"),
        F.when(count_side, F.round("median_ratio", 4)).alias("median_ratio"),
    )


def split_report(paired: DataFrame, binary: Sequence[str], counts: Sequence[str], label: str = "label") -> DataFrame:
    """The legitimate rows gate; the phishing rows are reported beside them."""
    judged = score_features(paired.filter(F.col(label) == C.LEGITIMATE), binary, counts)
    other = score_features(paired.filter(F.col(label) == C.PHISHING), binary, counts).select(
        "feature", F.col("metric").alias("phishing_metric"), F.col("value").alias("phishing_value"),
        F.col("passed").alias("phishing_passed"), F.col("n").alias("phishing_n"),
    )
    return judged.join(other, "feature", "left")


def demotions(report: DataFrame) -> DataFrame:
    """Sorted names of the features that failed, one row per name."""
    return report.filter(~F.col("passed")).select("feature").orderBy("feature")


def choose_scope(reports: DataFrame, scopes: Sequence[str] = ("anchor", "all_resources")) -> DataFrame:
    """Mean value of the three reference counts per scope, and which scope to keep.

    A missing value counts 0; the first scope wins a tie. ``reports`` has the
    columns scope, feature, value.
    """
    wanted = reports.filter(F.col("feature").isin("NoOfSelfRef", "NoOfExternalRef", "NoOfEmptyRef"))
    means = wanted.groupBy("scope").agg(F.avg(F.coalesce("value", F.lit(0.0))).alias("mean_value"))
    order = F.array_position(F.array(*map(F.lit, scopes)), F.col("scope"))
    best = means.agg(F.max(F.struct("mean_value", (-order).alias("o"), "scope"))["scope"].alias("kept"))
    return means.join(F.broadcast(best)).select("scope", "mean_value", (F.col("scope") == F.col("kept")).alias("chosen"))
