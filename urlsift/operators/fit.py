"""Fit: every statistic the transform will need, learned from a training table."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlsift import constants as K
from urlsift import contract as C
from urlsift.functions import url as U
from urlsift.functions.stats import sample_skewness
from urlsift.operators.quantiles import exact_quantiles
from urlsift.runtime import drop_written, lookup_join, written

# A cascade step with at most this many keys is replayed from literals, not a join.
LITERAL_KEYS = 4_000
# Runs of at most this many literal steps are written out one by one, which is compiled; a fold, which is interpreted, keeps longer plans short.
UNROLLED_STEPS = 6
# Moments of at most this many columns come from plain aggregates, which are compiled.
PLAIN_MOMENTS = 16


@dataclass(frozen=True)
class Spec:
    """Which columns play which part. The page layout is one instance of it."""

    keys: tuple[str, ...]
    features: tuple[str, ...]
    numeric: tuple[str, ...]
    counts: tuple[str, ...]
    binary: tuple[str, ...]
    cascade_key: tuple[str, ...]
    cascade_order: tuple[str, ...]
    category: str
    category_share: str
    category_zero: str | None = None
    url_chain: bool = False
    label: str = C.TARGET
    fallback: tuple[str, ...] = ()

    @property
    def integral(self) -> tuple[str, ...]:
        return (*self.binary, *self.counts)


PAGE_SPEC = Spec(
    keys=("id",), features=C.FEATURES, numeric=C.NUMERIC, counts=C.COUNTS, binary=C.BINARY,
    cascade_key=C.CASCADE_KEY, cascade_order=C.CASCADE_ORDER, category="TLD",
    category_share="TLDLegitimateProb", category_zero="IsDomainIP", url_chain=True,
    fallback=C.PAGE_FEATURES + C.TITLE_FEATURES,
)


@dataclass(frozen=True)
class NumericFill:
    method: str
    value: float | None
    skew: float | None


@dataclass(frozen=True)
class FittedStats:
    """Fitted values. What grows with the data (categories, modes) stays in tables;
    what is bounded by the number of columns is held as plain values."""

    spec: Spec
    n_rows: int
    char_shares: Mapping[str, float]
    category_means: DataFrame
    category_rows: int
    category_fill: float | None
    category_skew: float | None
    numeric_fill: Mapping[str, NumericFill]
    cascade: tuple[Modes, ...] = ()
    clip: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    scale: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    unusable: Mapping[str, str] = field(default_factory=dict)
    demoted: tuple[str, ...] = ()

    @property
    def global_modes(self) -> dict[str, float]:
        return {c: m.overall for c, m in zip(self.spec.cascade_order, self.cascade, strict=True)}


# --- characters and categories ---------------------------------------------------

def char_counts(df: DataFrame, url: str = "URL") -> DataFrame:
    """Occurrences of each alphanumeric character over all lower-case URLs."""
    chars = df.filter(F.col(url).isNotNull()).select(
        F.explode(F.split(F.lower(url), "")).alias("ch")
    )
    return chars.filter(F.col("ch").rlike(r"^[\p{L}\p{N}]$")).groupBy("ch").agg(F.count("*").alias("n"))


def char_shares(df: DataFrame, url: str = "URL") -> dict[str, float]:
    """Share per character; at most one entry per character of the alphabet."""
    counted = {r["ch"]: r["n"] for r in char_counts(df, url).collect()}
    total = sum(counted.values())
    return {c: n / total for c, n in counted.items()}


def category_means(df: DataFrame, category: str, share: str) -> DataFrame:
    """Mean share per category over the values as recorded."""
    return df.filter(F.col(category).isNotNull()).groupBy(category).agg(
        F.avg(share).alias("category_mean")
    ).filter(F.col("category_mean").isNotNull())


def moments(df: DataFrame, cols) -> dict[str, tuple[int, float | None, float | None]]:
    """Count, mean and sample skewness of the non-NULL values of each column.

    One scan. The columns are stacked, so the plan and its generated code stay small
    however many columns there are; the partial sums leave one row per column.
    """
    cols = list(cols)
    stacked = df.select(F.posexplode(F.array(*[F.col(c).cast("double") for c in cols])).alias("i", "v"))
    found = stacked.filter(F.col("v").isNotNull()).groupBy("i").agg(
        F.count("v").alias("n"), F.avg("v").alias("m"), sample_skewness("v").alias("s")
    ).collect()
    out = {c: (0, None, None) for c in cols}
    out.update({cols[r["i"]]: (r["n"], r["m"], r["s"]) for r in found})
    return out


def central_fill(df: DataFrame, cols, limit: float) -> dict[str, NumericFill]:
    """Mean per column, or the median where the skewness exceeds the limit.

    A second pass for medians runs only if some column is skewed, over those only.
    """
    found = moments(df, cols)
    skewed = [c for c in cols if found[c][2] is not None and abs(found[c][2]) > limit]
    medians = exact_quantiles(df, skewed, [0.5])
    return {
        c: NumericFill("median", medians[c][0], found[c][2]) if c in medians
        else NumericFill("mean", found[c][1], found[c][2])
        for c in cols
    }


# --- cascade of group modes ------------------------------------------------------

def _start_key(spec: Spec) -> Column:
    """The first grouping key as text. A NULL part gives a key no mode table knows."""
    return F.concat(
        *[F.concat(F.coalesce(F.col(c).cast("double").cast("string"), F.lit("null")), F.lit("|"))
          for c in spec.cascade_key]
    )


def _most_common(counted: DataFrame, by: list[str], value: str, weight: str) -> DataFrame:
    """Value with the largest weight per group, the smallest value on ties."""
    return counted.groupBy(*by).agg(
        (-F.max(F.struct(F.col(weight), -F.col(value)))["col2"]).alias("mode")
    )


def group_modes(df: DataFrame, keys: list[str], value: str, weight: str | None = None) -> DataFrame:
    """Most frequent non-NULL value per group; counts are combined before the shuffle."""
    n = F.sum(weight) if weight else F.count("*")
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(n.alias("_n"))
    return _most_common(counted, keys, value, "_n")


@dataclass(frozen=True)
class Modes:
    """Modes of one cascade step: the key rows, kept as values while they are few and as a
    table beyond that, and the overall mode."""

    overall: float
    n_keys: int
    rows: tuple[tuple[str, float], ...] | None
    table: DataFrame | None

    def exceptions(self) -> dict[float, list[str]]:
        """Keys whose mode differs from the overall one, by mode. The others need no naming."""
        by_value = {}
        for key, mode in self.rows:
            if mode != self.overall:
                by_value.setdefault(mode, []).append(key)
        return by_value


def _quoted(keys) -> str:
    return ", ".join(f"'{k}'" for k in keys)


def _folded_key(steps: list[tuple[str, Modes]]) -> Column:
    """The key in ``_key`` extended by the filled value of each column in turn.

    A row-local fold without joins: the key reached so far decides the mode, and
    membership in a literal list is a hash test. Keys of different steps differ in
    their number of parts, so one list serves all steps.
    """
    by_value = {}
    for _, modes in steps:
        for mode, keys in modes.exceptions().items():
            by_value.setdefault(mode, []).extend(keys)
    cases = " ".join(f"WHEN k IN ({_quoted(keys)}) THEN {m!r}D" for m, keys in sorted(by_value.items()))
    mode = f"CASE {cases} ELSE x.g END" if cases else "x.g"
    inputs = ", ".join(f"named_struct('v', double(`{c}`), 'g', {m.overall!r}D)" for c, m in steps)
    return F.expr(
        f"aggregate(array({inputs}), _key, (k, x) -> concat(k, string(coalesce(x.v, {mode})), '|'))"
    )


def _literal_steps(df: DataFrame, steps: list[tuple[str, Modes]]) -> DataFrame:
    """Extend ``_key`` over steps whose modes are literals."""
    if len(steps) > UNROLLED_STEPS:
        return df.withColumn("_key", _folded_key(steps))
    for column, modes in steps:
        cases = " ".join(f"WHEN _key IN ({_quoted(keys)}) THEN {m!r}D" for m, keys in sorted(modes.exceptions().items()))
        mode = f"CASE {cases} ELSE {modes.overall!r}D END" if cases else f"{modes.overall!r}D"
        df = df.withColumn("_key", F.expr(f"concat(_key, string(coalesce(double(`{column}`), {mode})), '|')"))
    return df


def _filled_steps(df: DataFrame, spec: Spec, steps: list[tuple[str, Modes]]) -> DataFrame:
    """The columns of few literal steps, filled in place: only a row with a hole makes a key, and only where some key's mode
    differs from the overall one."""
    for i, (column, modes) in enumerate(steps):
        mode = F.lit(float(modes.overall))
        known = sorted(modes.exceptions().items())
        if known:
            filled = [F.concat(F.col(f"`{c}`").cast("string"), F.lit("|")) for c, _ in steps[:i]]
            key = F.concat(_start_key(spec), *filled)
            for value, keys in known:
                mode = F.when(key.isin(keys), F.lit(float(value))).otherwise(mode)
        df = df.withColumn(column, F.coalesce(F.col(f"`{column}`").cast("double"), mode))
    return df


def _pick_modes(counted: list[tuple[str, float, int]]) -> Modes:
    """Modes from a short list of (key, value, count): largest count, then smallest value."""
    by_key, overall = {}, {}
    for key, value, n in counted:
        by_key.setdefault(key, []).append((-n, value))
        overall[value] = overall.get(value, 0) - n
    top = min(((n, v) for v, n in overall.items()), default=(0, 0.0))[1]
    rows = tuple(sorted((k, min(v)[1]) for k, v in by_key.items() if "null" not in k))
    return Modes(top, len(rows), rows, None)


def _extend_key(df: DataFrame, steps: list[tuple[str, Modes]]) -> DataFrame:
    """Extend ``_key`` over the steps: literal runs by one fold each, a large step by a join."""
    run = []
    for column, modes in steps:
        if modes.table is None:
            run.append((column, modes))
            continue
        if run:
            df, run = _literal_steps(df, run), []
        table = modes.table.select(F.col("key").alias("_key"), F.col("mode").alias("_mode"))
        joined = lookup_join(df, table, ["_key"])
        filled = F.coalesce(F.col(column).cast("double"), "_mode", F.lit(modes.overall))
        df = joined.withColumn("_key", F.concat("_key", filled.cast("string"), F.lit("|"))).drop("_mode")
    return _literal_steps(df, run) if run else df


def fit_cascade(df: DataFrame, spec: Spec, literal_keys: int = LITERAL_KEYS) -> tuple[Modes, ...]:
    """Mode tables of the ordered fill.

    The fill of a row depends on its two-valued columns alone, so the rows are first
    collapsed to counted patterns (one shuffle with map-side combining), which are
    written, and all steps run on those. Step n has at most 2**n keys for two-valued
    columns. A step with few keys becomes literals of the next steps' expression; a
    larger one is written and joined, with the patterns written again behind it, so
    that no plan grows with the steps and a lost executor costs one step.
    """
    order = list(spec.cascade_order)
    state = written(
        df.groupBy(*spec.cascade_key, *order).agg(F.count("*").alias("weight"))
        .withColumn("_key", _start_key(spec)), "patterns",
    )
    steps, pending = [], []
    for column in order:
        keyed = _extend_key(state, pending)
        counted = (
            keyed.filter(F.col(column).isNotNull())
            .groupBy(F.col("_key").alias("key"), F.col(column).cast("double").alias("mode"))
            .agg(F.sum("weight").alias("_n"))
        )
        # a probe of the size, not a cut: beyond it the modes are picked on the cluster
        probe = counted.limit(2 * literal_keys + 1).collect()
        if len(probe) <= 2 * literal_keys:
            modes = _pick_modes([(r["key"], r["mode"], r["_n"]) for r in probe])
            pending.append((column, modes))
        else:
            per_key = _most_common(counted.filter("key NOT LIKE '%null%'"), ["key"], "mode", "_n")
            top = _most_common(counted.groupBy("mode").agg(F.sum("_n").alias("_n")), [], "mode", "_n")
            table = written(per_key, "modes")
            modes = Modes(top.first()["mode"], table.count(), None, table)
            older, state = state, written(_extend_key(keyed, [(column, modes)]), "patterns")
            drop_written(older)
            pending = []
        steps.append(modes)
    drop_written(state)
    return tuple(steps)


def modes_table(stats: FittedStats, spark) -> DataFrame:
    """All steps as one table: step, column, key, mode."""
    local = [
        (i, c, k, m)
        for i, (c, modes) in enumerate(zip(stats.spec.cascade_order, stats.cascade, strict=True), start=1)
        if modes.rows is not None for k, m in modes.rows
    ]
    out = spark.createDataFrame(local, "step int, column string, key string, mode double")
    for i, (c, modes) in enumerate(zip(stats.spec.cascade_order, stats.cascade, strict=True), start=1):
        if modes.table is not None:
            out = out.unionByName(
                modes.table.select(F.lit(i).alias("step"), F.lit(c).alias("column"), "key", "mode")
            )
    return out


def replay_cascade(df: DataFrame, stats: FittedStats, count_missed: bool = False) -> DataFrame:
    """Fill NULL two-valued columns from the recorded modes, in the recorded order.

    With ``count_missed`` a flag per column tells that the overall mode was used.
    """
    spec = stats.spec
    steps = list(zip(spec.cascade_order, stats.cascade, strict=True))
    if not count_missed and len(steps) <= UNROLLED_STEPS and all(modes.table is None for _, modes in steps):
        return _filled_steps(df, spec, steps)
    first = len(spec.cascade_key)
    keyed = _extend_key(df.withColumn("_key", _start_key(spec)), steps)
    if count_missed:
        for i, (column, modes) in enumerate(steps):
            prefix = F.concat(F.substring_index("_key", "|", first + i), F.lit("|"))
            if modes.table is None:
                keys = _quoted(k for k, _ in modes.rows)
                known = F.expr(f"_prefix IN ({keys})") if keys else F.lit(False)
                keyed = keyed.withColumn("_prefix", prefix)
            else:
                table = modes.table.select(F.col("key").alias("_prefix"), F.lit(True).alias("_hit"))
                keyed = lookup_join(keyed.withColumn("_prefix", prefix), table, ["_prefix"])
                known = F.col("_hit").isNotNull()
            keyed = keyed.withColumn(f"_missed_{column}", F.col(column).isNull() & ~known).drop("_prefix", "_hit")
    parts = keyed.withColumn("_parts", F.split("_key", r"\|"))
    return parts.withColumns(
        {c: F.get("_parts", F.lit(first + i)).cast("double") for i, (c, _) in enumerate(steps)}
    ).drop("_key", "_parts")


# --- the fill stages shared by fit and transform ------------------------------------

def fill_category_share(df: DataFrame, spec: Spec, means: DataFrame, fill) -> DataFrame:
    """Recorded share, else 0 for an address, else the category mean, else the global fill."""
    table = means.withColumnRenamed(means.columns[0], spec.category)
    joined = lookup_join(df, table, [spec.category])
    options = [F.col(spec.category_share)]
    if spec.category_zero:
        options.append(F.when(F.col(spec.category_zero) == 1, F.lit(0.0)))
    options += [F.col("category_mean"), F.lit(fill).cast("double")]
    return joined.withColumn(spec.category_share, F.coalesce(*options)).drop("category_mean")


def stage_records(df: DataFrame, stats: FittedStats) -> DataFrame:
    """Derived values filled, other holes still open."""
    if stats.spec.url_chain:
        df = U.fill_url_features(df, stats.char_shares)
    return fill_category_share(
        df, stats.spec, stats.category_means, stats.category_fill
    )


def fill_numeric(df: DataFrame, fills: Mapping[str, NumericFill]) -> DataFrame:
    return df.fillna({c: f.value for c, f in fills.items() if f.value is not None})


def clip_numeric(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns(
        {
            c: F.when(F.col(c).isNotNull(), F.greatest(F.least(F.col(c), F.lit(hi)), F.lit(lo)))
            for c, (lo, hi) in bounds.items()
        }
    )


def coerce_integral(df: DataFrame, cols) -> DataFrame:
    """Whole-number columns as bigint; fractions are cut toward zero."""
    return df.withColumns({c: F.col(c).cast("bigint") for c in cols})


def vector_moments(df: DataFrame, cols, by: str | None = None, extra=()) -> dict:
    """Count, mean, sum of squared deviations, minimum and maximum per column and group.

    Few columns are plain aggregates. More travel as one vector through one aggregator, so a wide table needs no
    wide generated code. ``extra`` are 0/1 columns of which only the maximum is kept.
    """
    values = [F.col(c).cast("double") if isinstance(c, str) else c for c in cols]
    if len(values) <= PLAIN_MOMENTS:
        return _plain_moments(df, values, by, extra)
    whole = array_to_vector(F.array(*values))
    parts = Summarizer.metrics("mean", "variance", "min", "max", "count").summary(whole).alias("m")
    aggs = [parts]
    if extra:
        aggs.append(Summarizer.max(array_to_vector(F.array(*extra))).alias("e"))
    grouped = df.groupBy(by) if by else df.groupBy()
    out = {}
    for r in grouped.agg(*aggs).collect():
        m = r["m"]
        n = m["count"]
        out[r[by] if by else None] = {
            "n": n, "mean": m["mean"].toArray().tolist(),
            "ss": (m["variance"].toArray() * (n - 1)).tolist(),
            "min": m["min"].toArray().tolist(), "max": m["max"].toArray().tolist(),
            "extra": r["e"].toArray().tolist() if extra else [],
        }
    return out


def _plain_moments(df: DataFrame, values: list[Column], by: str | None, extra) -> dict:
    ends = {"mean": F.avg, "variance": F.var_pop, "min": F.min, "max": F.max}
    aggs = [f(x).alias(f"{k}_{i}") for i, x in enumerate(values) for k, f in ends.items()]
    grouped = df.groupBy(F.col(by).alias("group")) if by else df.groupBy(F.lit(None).alias("group"))
    out = {}
    for r in grouped.agg(F.count("*").alias("n"), *aggs, *[F.max(e).alias(f"extra_{j}") for j, e in enumerate(extra)]).collect():
        parts = {k: [r[f"{k}_{i}"] for i in range(len(values))] for k in ends}
        squares = [v * r["n"] for v in parts.pop("variance")]
        out[r["group"]] = {"n": r["n"], **parts, "ss": squares, "extra": [r[f"extra_{j}"] for j in range(len(extra))]}
    return out


def pooled(groups: dict) -> dict:
    """Moments of all groups together, from the moments of each."""
    parts = [g for g in groups.values() if g["n"]]
    n = sum(g["n"] for g in parts)
    width = range(len(parts[0]["mean"]))
    mean = [sum(g["n"] * g["mean"][i] for g in parts) / n for i in width]
    return {
        "n": n, "mean": mean,
        "ss": [sum(g["ss"][i] + g["n"] * (g["mean"][i] - mean[i]) ** 2 for g in parts) for i in width],
        "min": [min(g["min"][i] for g in parts) for i in width],
        "max": [max(g["max"][i] for g in parts) for i in width],
    }


def scaler_and_unusable(df: DataFrame, spec: Spec):
    """Scaler values and the columns naive Bayes cannot use, from one scan.

    A two-valued column fails when a (value, label) cell is empty, any column when
    it is constant; the first reason stands.
    """
    cells = [(F.col(c) == v).cast("double") for c in spec.binary for v in (0, 1)]
    groups = vector_moments(df, spec.features, spec.label, cells)
    total = pooled(groups)
    at = {c: i for i, c in enumerate(spec.features)}
    constant = {c for c, i in at.items() if total["min"][i] == total["max"][i]}
    scale = {
        c: (total["min"][at[c]] if c in constant else total["mean"][at[c]],
            1.0 if c in constant else math.sqrt(total["ss"][at[c]] / total["n"]))
        for c in spec.numeric
    }
    unusable = {}
    for j, c in enumerate(spec.binary):
        seen = [groups[y]["extra"][2 * j + v] if y in groups else 0.0 for y in (0, 1) for v in (0, 1)]
        if not all(seen):
            unusable[c] = "empty_contingency_cell"
    for c in spec.features:
        if c in constant and c not in unusable:
            unusable[c] = "zero_std"
    return scale, unusable


def standardise(df: DataFrame, scale: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) + F.lit(0.0) for c, (m, s) in scale.items()})


def fit(df: DataFrame, spec: Spec = PAGE_SPEC, demoted: tuple[str, ...] = ()) -> FittedStats:
    """Learn every statistic from a raw training table.

    The table is read for the character and category statistics, then once more
    to derive the features, which are written; the remaining scans read that.
    """
    shares = char_shares(df) if spec.url_chain else {}
    means = written(category_means(df, spec.category, spec.category_share), "category")
    share_fill = central_fill(df, [spec.category_share], K.TLD_SKEW_LIMIT)[spec.category_share]
    stats = FittedStats(
        spec=spec, n_rows=0, char_shares=shares, category_means=means, category_rows=means.count(),
        category_fill=share_fill.value, category_skew=share_fill.skew, numeric_fill={},
        demoted=tuple(sorted(demoted)),
    )
    staged = written(
        stage_records(df, stats).select(*spec.keys, *spec.features, spec.label), "staged"
    )
    fills = central_fill(staged, spec.numeric, K.NUMERIC_SKEW_LIMIT)
    n_rows = staged.count()
    stats = replace(stats, n_rows=n_rows, numeric_fill=fills, cascade=fit_cascade(staged, spec))
    filled = fill_numeric(staged, fills)
    ends = exact_quantiles(
        filled, spec.numeric, [0.01, 0.99]
    )
    clip = {c: (e[0], e[1]) for c, e in ends.items() if e[0] is not None}
    whole = coerce_integral(clip_numeric(replay_cascade(filled, stats), clip), spec.integral)
    scale, unusable = scaler_and_unusable(whole, spec)
    drop_written(staged)
    return replace(stats, clip=clip, scale=scale, unusable=unusable)


def fallback_rows(stats: FittedStats) -> list[tuple[str, float, str]]:
    """For each feature that may have no page behind it: the value used and its source."""
    rows = []
    for c in stats.spec.fallback:
        if c in stats.numeric_fill:
            f = stats.numeric_fill[c]
            rows.append((c, f.value, f"numeric_{f.method}"))
        elif c in stats.global_modes:
            rows.append((c, float(stats.global_modes[c]), "categorical_mode"))
    return rows
