"""Aggregate expressions the built-ins give in a different flavour."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample_skewness(c: str | Column) -> Column:
    """Bias-corrected skewness; the built-in is the population form."""
    n = F.count(c).cast("double")
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def safe_ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 when the denominator is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def rounded(df: DataFrame, cols: Sequence[str], digits: int) -> DataFrame:
    """``F.round`` of columns of doubles, for tables of many rows.

    The built-in goes through decimal text, which costs more than all else of a wide result. Here Arrow batches are
    rounded as arrays, and only values near a tie, large ones and such that are no numbers are left to the built-in.
    """
    unit = 10.0**digits

    @F.arrow_udf("struct<" + ", ".join(f"r{i}: double" for i in range(len(cols))) + ">")
    def plain(*columns: pa.Array) -> pa.Array:
        found = []
        for c in columns:
            x = c.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
            with np.errstate(invalid="ignore", over="ignore"):
                scaled = x * unit
                sure = (np.abs(scaled) < 1e9) & (np.abs(scaled - np.floor(scaled) - 0.5) > 1e-6)
                found.append(pa.array(np.floor(scaled + 0.5) / unit + 0.0, pa.float64(), mask=~sure))
        return pa.StructArray.from_arrays(found, [f"r{i}" for i in range(len(found))])

    staged = df.withColumn("_rounded", plain(*[F.col(c) for c in cols]))
    return staged.withColumns({c: F.coalesce(F.col(f"_rounded.r{i}"), F.round(c, digits)) for i, c in enumerate(cols)}).drop("_rounded")
