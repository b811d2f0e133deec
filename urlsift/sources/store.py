"""Fitted statistics and models as tables, with a version check on load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlsift import constants as K
from urlsift.operators.fit import (
    LITERAL_KEYS, PAGE_SPEC, FittedStats, Modes, NumericFill, Spec, fallback_rows, modes_table,
)
from urlsift.operators.naive_bayes import NaiveBayes


class VersionError(RuntimeError):
    """The stored statistics were written for another version or layout."""


def save_stats(spark: SparkSession, stats: FittedStats, path: str) -> None:
    """One table per statistic family."""
    spec = stats.spec

    def put(name: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"{path}/{name}")

    def rows(name, data, schema):
        put(name, spark.createDataFrame(data, schema).coalesce(1))

    rows("char_shares", list(stats.char_shares.items()), "ch string, share double")
    put("category_means", stats.category_means)
    rows("numeric_fill", [(c, f.method, f.value, f.skew) for c, f in stats.numeric_fill.items()],
         "column string, method string, value double, skew double")
    put("modes", modes_table(stats, spark))
    rows("cascade", [(i, c, m.overall, m.n_keys) for i, (c, m) in enumerate(zip(spec.cascade_order, stats.cascade, strict=True), 1)],
         "step int, column string, overall double, n_keys long")
    rows("clip", [(c, lo, hi) for c, (lo, hi) in stats.clip.items()], "column string, lower double, upper double")
    rows("scale", [(c, m, s) for c, (m, s) in stats.scale.items()], "column string, mean double, scale double")
    rows("unusable", list(stats.unusable.items()), "column string, reason string")
    rows("fallbacks", fallback_rows(stats), "column string, value double, source string")
    rows("demoted", [(c,) for c in stats.demoted], "column string")
    rows(
        "meta",
        [(K.SCHEMA_VERSION, K.KEYWORD_LIST_VERSION, len(spec.features), list(spec.features), stats.n_rows,
          stats.category_rows, stats.category_fill, stats.category_skew)],
        "schema_version int, keyword_list_version string, feature_count int, features array<string>, n_rows long, "
        "category_rows long, category_fill double, category_skew double",
    )


def load_stats(spark: SparkSession, path: str, spec: Spec = PAGE_SPEC) -> FittedStats:
    meta = spark.read.parquet(f"{path}/meta").first()
    found = (meta["schema_version"], meta["keyword_list_version"], meta["feature_count"])
    wanted = (K.SCHEMA_VERSION, K.KEYWORD_LIST_VERSION, len(spec.features))
    if found != wanted:
        raise VersionError(f"stored statistics have version {found}, this code needs {wanted}")
    if tuple(meta["features"]) != tuple(spec.features):
        raise VersionError("stored statistics were fitted on another feature order")

    def get(name):
        return {r[0]: tuple(r)[1:] for r in spark.read.parquet(f"{path}/{name}").collect()}

    modes = spark.read.parquet(f"{path}/modes")
    steps = {r["step"]: r for r in spark.read.parquet(f"{path}/cascade").collect()}
    short = [i for i, r in steps.items() if r["n_keys"] <= LITERAL_KEYS]
    local = {}
    for r in modes.filter(F.col("step").isin(short)).collect():
        local.setdefault(r["step"], []).append((r["key"], r["mode"]))
    cascade = []
    for i, r in sorted(steps.items()):
        if i in short:
            cascade.append(Modes(r["overall"], r["n_keys"], tuple(sorted(local.get(i, []))), None))
        else:
            table = modes.filter(F.col("step") == i).select("key", "mode")
            cascade.append(Modes(r["overall"], r["n_keys"], None, table))
    return FittedStats(
        spec=spec, n_rows=meta["n_rows"],
        char_shares={c: s for c, (s,) in get("char_shares").items()},
        category_means=spark.read.parquet(f"{path}/category_means"),
        category_rows=meta["category_rows"], category_fill=meta["category_fill"],
        category_skew=meta["category_skew"],
        numeric_fill={c: NumericFill(*v) for c, v in get("numeric_fill").items()},
        cascade=tuple(cascade), clip=get("clip"), scale=get("scale"),
        unusable={c: r for c, (r,) in get("unusable").items()},
        demoted=tuple(sorted(get("demoted"))),
    )


def save_naive_bayes(spark: SparkSession, model: NaiveBayes, path: str) -> None:
    rows = [
        (k, i, f, model.mean[k][i], model.std[k][i], model.log_prior[k])
        for k in (0, 1) for i, f in enumerate(model.features)
    ]
    schema = "label int, ord int, feature string, mean double, std double, log_prior double"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)


def load_naive_bayes(spark: SparkSession, path: str) -> NaiveBayes:
    rows = sorted(spark.read.parquet(path).collect(), key=lambda r: (r["label"], r["ord"]))
    by_class = [[r for r in rows if r["label"] == k] for k in (0, 1)]
    return NaiveBayes(
        tuple(r["feature"] for r in by_class[0]),
        tuple(c[0]["log_prior"] for c in by_class),
        tuple(tuple(r["mean"] for r in c) for c in by_class),
        tuple(tuple(r["std"] for r in c) for c in by_class),
    )
