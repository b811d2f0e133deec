"""Minority oversampling by interpolation between near neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsift.operators.knn import nearest, usable
from urlsift.operators.ordering import positions
from urlsift.runtime import written


def _uniform(*cols, seed: int):
    """A repeatable number in [0, 1) from the row's own values."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 10), 16, 10).cast("long").cast("double") / float(1 << 40)


def smote(
    df: DataFrame, *, key: str, features: str = "features", label: str = "label", k: int = 5,
    seed: int = 42, **knn_options,
) -> DataFrame:
    """Rows plus synthetic minority rows until both classes are equally large.

    Each synthetic row starts at a minority row picked by hash and moves a random
    part of the way to one of its k nearest minority neighbours. Picks depend on
    the seed and row numbers only, so a rerun gives the same rows. Minority rows whose vector is NULL or holds a NULL, NaN
    or infinity stay, and are no origin or partner. Columns: key
    (NULL for synthetic rows), label, features, origin, partner, gap.
    """
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}
    if len(counts) != 2:
        raise ValueError(f"two classes are needed, found {sorted(counts)}")
    minority = min(counts, key=lambda y: (counts[y], y))
    need = max(counts.values()) - counts[minority]
    few = df.filter(F.col(label) == minority).select(key, usable(features).alias(features), label).filter(F.col(features).isNotNull())
    have = few.count()
    if have < 2:
        raise ValueError("the minority class needs at least two rows")
    refs = few.select(F.col(key).cast("long").alias("id"), features, label)
    # the nearest neighbour of a point is itself, or a twin with a smaller id
    found = nearest(few, refs, keys=[key], vector=features, label=label, k=min(k, have - 1) + 1, **knn_options)
    partners = found.select(
        F.col(key).alias("origin"),
        F.slice(
            F.filter(F.transform("neighbours", lambda n: n["ref_id"]), lambda i: i != F.col(key).cast("long")),
            1, min(k, have - 1),
        ).alias("partners"),
    )
    numbered = written(
        positions(few.select(F.col(key).alias("origin"), F.col(features).alias("_from")), "origin")
        .join(partners, "origin"),
        "minority",
    )
    picks = df.sparkSession.range(need).select(
        F.col("id").alias("_i"),
        (F.floor(_uniform("id", seed=seed) * have) + 1).cast("long").alias("position"),
        _uniform("id", seed=seed + 1).alias("_u"),
        _uniform("id", seed=seed + 2).alias("gap"),
    )
    chosen = picks.join(numbered, "position").withColumn(
        "partner", F.element_at("partners", (F.floor(F.col("_u") * F.size("partners")) + 1).cast("int"))
    )
    ends = few.select(F.col(key).cast("long").alias("partner"), F.col(features).alias("_to"))
    moved = F.zip_with(
        "_from", "_to", lambda a, b: (a + F.col("gap") * (b - a)).cast("float")
    )
    synthetic = chosen.join(ends, "partner").select(
        F.lit(None).cast(df.schema[key].dataType).alias(key), F.lit(minority).cast(df.schema[label].dataType).alias(label),
        moved.alias(features), "origin", "partner", "gap",
    )
    originals = df.select(
        key, label, features, F.lit(None).cast(df.schema[key].dataType).alias("origin"),
        F.lit(None).cast("long").alias("partner"), F.lit(None).cast("double").alias("gap"),
    )
    return originals.unionByName(synthetic)
