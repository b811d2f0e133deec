"""Transform: apply fitted statistics to rows. Nothing is computed from the rows scored,
so one row, a batch of any size and a stream give the same vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsift import contract as C
from urlsift.operators import fit as FT
from urlsift.operators.fit import FittedStats


def _carried(df: DataFrame, stats: FittedStats, keep) -> list[str]:
    return [c for c in dict.fromkeys((*stats.spec.keys, *keep)) if c in df.columns]


def fill_records(df: DataFrame, stats: FittedStats, count_missed: bool = False) -> DataFrame:
    """All holes filled; still on the original scale."""
    spec = stats.spec
    required = [*spec.keys, *spec.features, spec.category]
    if spec.url_chain:
        required += C.TEXT
    staged = FT.stage_records(C.require_columns(df, required), stats)
    return FT.replay_cascade(FT.fill_numeric(staged, stats.numeric_fill), stats, count_missed)


def prepare(df: DataFrame, stats: FittedStats, keep=()) -> DataFrame:
    """Filled, clipped, whole-number columns cut; not yet standardised."""
    spec = stats.spec
    kept = _carried(df, stats, keep)
    filled = fill_records(df, stats).select(*kept, *spec.features)
    return FT.coerce_integral(FT.clip_numeric(filled, stats.clip), spec.integral)


def transform(df: DataFrame, stats: FittedStats, keep=()) -> DataFrame:
    """Keys, kept columns and the standardised features in contract order."""
    return FT.standardise(prepare(df, stats, keep), stats.scale)


def transform_leaky(df: DataFrame, stats: FittedStats, keep=()) -> DataFrame:
    """The defective profile kept for comparison: after the ordinary transform the
    given rows are standardised once more by their own mean and deviation."""
    scaled = transform(df, stats, keep)
    own, _ = FT.scaler_and_unusable(scaled.withColumn(stats.spec.label, F.lit(0)), stats.spec)
    return FT.standardise(scaled, own)


def to_vector(df: DataFrame, features, name: str = "features") -> DataFrame:
    """Replace the feature columns by one array<float> in order."""
    vector = F.array(*[F.col(c).cast("float") for c in features]).alias(name)
    return df.select(*[c for c in df.columns if c not in set(features)], vector)


def cascade_misses(df: DataFrame, stats: FittedStats) -> DataFrame:
    """Per cascade step, how many rows had to use the global mode."""
    order = stats.spec.cascade_order
    counted = fill_records(df, stats, count_missed=True).agg(
        *[F.count_if(f"_missed_{c}").alias(c) for c in order]
    )
    return counted.unpivot([], list(order), "column", "misses")
