"""Profiles of a table: missingness, class shares, distributions, outliers, scalers."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlsift.runtime import drop_written, small, written

from urlsift import contract as C
from urlsift.operators.fit import moments, pooled, vector_moments
from urlsift.operators.quantiles import exact_quantiles


def null_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows, NULLs and NULL share per column, one scan."""
    n = F.count("*")
    items = [
        F.struct(
            F.lit(c).alias("column"), n.alias("n_rows"), F.count_if(F.col(c).isNull()).alias("nulls")
        )
        for c in cols
    ]
    one = df.agg(F.array(*items).alias("r"))
    return one.select(F.explode("r").alias("r")).select("r.*").withColumn(
        "null_rate", F.when(F.col("n_rows") > 0, F.col("nulls") / F.col("n_rows")).otherwise(0.0)
    )


def missing_ranking(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return null_profile(df, cols).select("column", "null_rate").orderBy(F.desc("null_rate"), "column")


def median_nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Median over the columns of their NULL counts (one value per column)."""
    return null_profile(df, cols).agg(F.median("nulls").alias("median_nulls"))


def class_profile(df: DataFrame, label: str = C.TARGET) -> DataFrame:
    """Rows and share per class."""
    counted = df.groupBy(label).agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n").alias("_total"))
    return counted.join(F.broadcast(total)).select(label, "n", (F.col("n") / F.col("_total")).alias("share"))


def class_means(df: DataFrame, cols: Sequence[str], label: str = C.TARGET) -> DataFrame:
    return df.groupBy(label).agg(*[F.avg(c).alias(c) for c in cols])


def reference_stats(df: DataFrame, features: Sequence[str], label: str = C.TARGET) -> DataFrame:
    """Distribution of each feature, and mean and deviation per class (population form).

    The features are written once, as the quantiles take several scans.
    """
    stored = written(df.select(*features, label), "features")
    groups = vector_moments(stored, features, label)
    total = pooled(groups)
    ends = exact_quantiles(
        stored, features, [0.01, 0.25, 0.5, 0.75, 0.99]
    )
    drop_written(stored)
    rows = []
    for i, c in enumerate(features):
        row = [c, total["min"][i], *ends[c], total["max"][i]]
        for y in (C.PHISHING, C.LEGITIMATE):
            g = groups.get(y)
            row += [g["mean"][i], math.sqrt(g["ss"][i] / g["n"])] if g else [None, None]
        rows.append(tuple(row))
    return df.sparkSession.createDataFrame(
        rows,
        "feature string, min double, p1 double, p25 double, median double, p75 double, p99 double, "
        "max double, mean_phishing double, std_phishing double, mean_legitimate double, std_legitimate double",
    )


def histogram(df: DataFrame, column: str, label: str = C.TARGET, bins: int = 30) -> DataFrame:
    """Counts per equal-width bin and class. Bins are closed on the right; the first one
    also holds the minimum. Empty cells are 0; the middle of each bin is given."""
    known = df.filter(F.col(column).isNotNull())
    ends = known.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi")).first()
    lo, hi = ends["lo"], ends["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, middle double, phishing long, legitimate long")
    if lo == hi:
        pad = 0.001 * abs(lo) if lo else 0.001
        lo, hi = lo - pad, hi + pad
    width = (hi - lo) / bins
    at = F.least(F.greatest(F.ceil((F.col(column) - F.lit(lo)) / F.lit(width)), F.lit(1)), F.lit(bins))
    counted = known.groupBy(at.cast("int").alias("bin")).agg(
        F.count_if(F.col(label) == C.PHISHING).alias("phishing"),
        F.count_if(F.col(label) == C.LEGITIMATE).alias("legitimate"),
    )
    first = lo - 0.001 * (hi - lo)
    left = F.when(F.col("bin") == 1, F.lit(first)).otherwise(F.lit(lo) + (F.col("bin") - 1) * F.lit(width))
    middle = (left + F.lit(lo) + F.col("bin") * F.lit(width)) / 2
    return counted.select("bin", middle.alias("middle"), "phishing", "legitimate")


def top_values(df: DataFrame, column: str, n: int = 30) -> DataFrame:
    """The n most frequent values; equal counts in value order."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), column).limit(n)


def outliers(df: DataFrame, cols: Sequence[str], skew_limit: float = 3.0, z_limit: float = 3.0) -> DataFrame:
    """Outliers per column: beyond z deviations, or beyond the quartile fences where skewed."""
    found = moments(df, cols)
    skewed = [c for c in cols if found[c][2] is not None and abs(found[c][2]) > skew_limit]
    fences = exact_quantiles(df, skewed, [0.25, 0.75])
    plain = [c for c in cols if c not in fences]
    spread = df.agg(*[F.stddev_pop(c).alias(c) for c in plain]).first() if plain else {}
    items = []
    for c in cols:
        v = F.col(c).cast("double")
        if c in fences:
            q1, q3 = fences[c]
            low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
            beyond, method = (v < low) | (v > high), "IQR"
        else:
            mean, std = found[c][1], spread[c]
            beyond = F.abs((v - F.lit(mean)) / F.lit(std)) > z_limit if std else F.lit(False)
            method = "Z-Score"
        items.append(
            F.struct(F.lit(c).alias("feature"), F.count_if(beyond).alias("outliers"), F.lit(method).alias("method"))
        )
    return df.agg(F.array(*items).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def columns_in_range(df: DataFrame, cols: Sequence[str], low: float, high: float) -> list[str]:
    """Columns whose values all lie in [low, high]; one scan, NULLs ignored."""
    ends = df.agg(*[F.min(c).alias(f"{c}_lo") for c in cols], *[F.max(c).alias(f"{c}_hi") for c in cols]).first()
    return [c for c in cols if ends[f"{c}_lo"] is not None and ends[f"{c}_lo"] >= low and ends[f"{c}_hi"] <= high]


def log_form(df: DataFrame, cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """log(1 + x) of the columns within 0..1000; the others are left out."""
    fit = columns_in_range(df, cols, 0, 1000)
    return df.select(*keys, *[F.log1p(c).alias(c) for c in fit])


def sqrt_form(df: DataFrame, cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Square root of the columns within 0..15; the others are left out."""
    fit = columns_in_range(df, cols, 0, 15)
    return df.select(*keys, *[F.sqrt(c).alias(c) for c in fit])


def percentile_clip(df: DataFrame, cols: Sequence[str], low: float = 0.01, high: float = 0.99) -> DataFrame:
    ends = exact_quantiles(df, cols, [low, high])
    return df.withColumns(
        {
            c: F.when(F.col(c).isNotNull(), F.greatest(F.least(F.col(c), F.lit(hi)), F.lit(lo)))
            for c, (lo, hi) in ends.items() if lo is not None
        }
    )


def _scaled(df: DataFrame, centre: dict, width: dict) -> DataFrame:
    """(x - centre) / width; a width of 0 counts as 1."""
    def one(c) -> Column:
        return (F.col(c) - F.lit(centre[c])) / F.lit(width[c] or 1.0)

    return df.withColumns({c: one(c) for c in centre if centre[c] is not None})


def min_max_scale(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    r = df.agg(*[F.min(c).alias(f"{c}_lo") for c in cols], *[F.max(c).alias(f"{c}_hi") for c in cols]).first()
    known = [c for c in cols if r[f"{c}_lo"] is not None]
    return _scaled(df, {c: r[f"{c}_lo"] for c in known}, {c: r[f"{c}_hi"] - r[f"{c}_lo"] for c in known})


def robust_scale(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    ends = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    known = [c for c in cols if ends[c][0] is not None]
    return _scaled(df, {c: ends[c][1] for c in known}, {c: ends[c][2] - ends[c][0] for c in known})


def standard_scale(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Standardise by the mean and population deviation of this very table."""
    r = df.agg(*[F.avg(c).alias(f"{c}_m") for c in cols], *[F.stddev_pop(c).alias(f"{c}_s") for c in cols]).first()
    known = [c for c in cols if r[f"{c}_m"] is not None]
    return _scaled(df, {c: r[f"{c}_m"] for c in known}, {c: r[f"{c}_s"] for c in known})


def _fingerprints(df: DataFrame) -> DataFrame:
    """The rows as one column beside 128 bits of hash; missing values count, as do the places of values."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    missing = F.concat(F.lit(""), *[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    return df.select(F.struct(*cols).alias("row"), F.xxhash64(missing, *cols).alias("h1"), F.xxhash64(F.lit(1), *reversed(cols), missing).alias("h2"))


def _met(prints: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts of the fingerprints, and the rows whose fingerprint another row has too."""
    counts = written(prints.groupBy("h1", "h2").agg(F.count("*").alias("n")), "fingerprints")
    several = counts.filter("n > 1").select("h1", "h2")
    return counts, prints.join(small(several), ["h1", "h2"], "left_semi")


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and surplus copies. Fingerprints are counted first; whole rows are compared only where these meet."""
    counts, met = _met(_fingerprints(df))
    rows = counts.agg(F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("n_rows"), F.count_if(F.col("n") == 1).alias("single"))
    distinct = met.groupBy("row").agg(F.lit(1)).agg(F.count("*").alias("several"))
    both = rows.crossJoin(F.broadcast(distinct))  # one row each
    n_distinct = F.col("single") + F.col("several")
    return both.select("n_rows", n_distinct.alias("n_distinct"), (F.col("n_rows") - n_distinct).alias("duplicates"))


def deduplicated(df: DataFrame) -> DataFrame:
    """Each distinct row once. Rows whose fingerprint no other row has stay where they are while the others' are few."""
    prints = _fingerprints(df)
    counts, met = _met(prints)
    several = counts.filter("n > 1").select("h1", "h2")
    alone = prints.join(small(several), ["h1", "h2"], "left_anti").select("row")
    return alone.union(met.select("row").dropDuplicates()).select("row.*")


def derived_features(df: DataFrame) -> DataFrame:
    """Sums of popups and of references, and whether the page shows solid information."""
    solid = (F.col("HasCopyrightInfo") == 1) | (F.col("HasSocialNet") == 1)
    return df.withColumns(
        {
            "NoOfPops": F.col("NoOfPopup") + F.col("NoOfiFrame"),
            "NoOfHref": F.col("NoOfSelfRef") + F.col("NoOfEmptyRef") + F.col("NoOfExternalRef"),
            "HasSolidInfo": F.when(solid, 1).otherwise(0),
        }
    )
