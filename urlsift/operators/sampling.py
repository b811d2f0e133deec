"""Splits and stratified samples that depend on row keys only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64


def hash_split(df: DataFrame, keys: Sequence[str], share: float = 0.8, seed: int = 42, name: str = "split") -> DataFrame:
    """Mark each row train or validation by a hash of its key: row-local, and stable under
    any partitioning or order."""
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed)))
    point = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 1_000_000
    return df.withColumn(name, F.when(point < int(share * 1_000_000), "train").otherwise("validation"))


def sample_per_stratum(
    df: DataFrame, stratum: str, sizes: Mapping | int, order: Sequence[Column | str],
) -> DataFrame:
    """The first rows of each stratum in the given order, up to its size.

    A stratum may hold nearly all rows. It is first cut over salts, each keeping at
    most the wanted number, and only those meet in the stratum's own task, so the
    last step sees at most salts times the size. No wanted row can be lost on the way.
    """
    if isinstance(sizes, int):
        limit, most = F.lit(sizes), sizes
    else:
        most = max(sizes.values(), default=0)
        pairs = [F.when(F.col(stratum) == k, F.lit(n)) for k, n in sizes.items()]
        limit = F.coalesce(*pairs, F.lit(0))
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(SALTS))
    spread = df.withColumns({"_limit": limit, "_salt": salt})
    part = Window.partitionBy(stratum, "_salt").orderBy(*order)
    # the largest limit as a literal lets the planner stop each group's sort early
    first = spread.withColumn("_rn", F.row_number().over(part)).filter(F.col("_rn") <= most)
    whole = Window.partitionBy(stratum).orderBy(*order)
    last = first.withColumn("_rn", F.row_number().over(whole)).filter(F.col("_rn") <= most)
    last = last.filter(F.col("_rn") <= F.col("_limit"))
    return last.drop("_limit", "_salt", "_rn")


def record_stratum(url: str = "URL", domain: str = "Domain", label: str = "label") -> Column:
    """Which of the four strata a raw record belongs to."""
    return (
        F.when(F.col(url).isNull(), "url_missing")
        .when(F.col(domain).isNull(), "domain_missing_url_present")
        .when(F.col(label) == 0, "both_present_phishing")
        .when(F.col(label) == 1, "both_present_legitimate")
    )


STRATA = (
    "url_missing", "domain_missing_url_present", "both_present_phishing", "both_present_legitimate",
)


def four_strata(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """A quarter of n from each stratum; an empty stratum is an error."""
    marked = df.withColumn("stratum", record_stratum())
    present = {r["stratum"] for r in marked.groupBy("stratum").count().collect()}
    empty = [s for s in STRATA if s not in present]
    if empty:
        raise ValueError(f"empty strata: {empty}")
    return sample_per_stratum(marked, "stratum", {s: n // len(STRATA) for s in STRATA}, order)


def balanced_urls(df: DataFrame, n: int, order: Sequence[Column | str], label: str = "label") -> DataFrame:
    """n / 2 records with a URL from each class."""
    return sample_per_stratum(df.filter(F.col("URL").isNotNull()), label, {0: n // 2, 1: n // 2}, order)


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The batch limit: the first n rows in key order."""
    return df.orderBy(*order).limit(n)
