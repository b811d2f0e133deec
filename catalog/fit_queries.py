"""Fit statistics and the transform, on line items and on page records."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.fit_sql import fit_ctes, q
from catalog.fixtures import (
    LINE_BINARY, LINE_KEY, LINE_NUMERIC, RAW_LINEITEM_SQL, hole, hole_sql, pages_rich, raw_lineitem,
)
from catalog.page_queries import ALL_PAGE_SQL
from catalog.url_queries import AUTH, SQL_EXPR, TLD_SQL, title_score_sql
from urlsift import contract as C
from urlsift.functions import url as U
from urlsift.functions.stats import sample_skewness
from urlsift.operators import fit as FT
from urlsift.operators import page_features as P
from urlsift.operators import transform as TR
from urlsift.operators.quantiles import exact_quantiles
from urlsift.runtime import written

QUERIES, SQL = {}, {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


LINE_SPEC = FT.Spec(
    keys=LINE_KEY, features=(*LINE_NUMERIC, "month_share", *LINE_BINARY),
    numeric=(*LINE_NUMERIC, "month_share"), counts=("quantity",), binary=LINE_BINARY,
    cascade_key=("is_return",), cascade_order=("is_open", "is_large", "is_deal"),
    category="month", category_share="month_share", fallback=("quantity", "tax", "is_deal"),
)
TRAIN = "split = 'train'"

# --- page records with holes ------------------------------------------------------------

# recorded values for the columns that need fitted tables or titles
RECORDED = {
    "TLDLegitimateProb": (17, 101, 100.0), "URLCharProb": (19, 89, 1000.0),
    "DomainTitleMatchScore": (23, 100, 1.0), "URLTitleMatchScore": (29, 97, 1.0),
}


def _pattern(name):
    i = C.RAW.index(name)
    return (i * 7 + 3) % 96 + 1, (i * 13 + 5) % 97


def build_raw_pages(spark, sf_dir):
    """Page records in the raw layout: derived values with holes, label and split."""
    pages = pages_rich(spark, sf_dir)
    page = P.page_features(pages, keys=("page_id", "url"))
    k = F.col("page_id")
    full = (
        U.url_features(page.withColumnRenamed("url", "URL"), "URL")
        .withColumns({c: (k * m % n) / F.lit(d) for c, (m, n, d) in RECORDED.items()})
    )
    cols = [k.alias("id"), F.when(k % 10 >= 3, F.col("URL")).alias("URL"),
            F.when(k % 2 == 1, F.col("Domain")).alias("Domain")]
    for c in ("TLD", "Title", *C.FEATURES):
        value = F.col(c) if c in C.TEXT else F.col(c).cast("double")
        cols.append(F.when(~hole(k, *_pattern(c)), value).alias(c))
    cols.append(F.when(k % 13 == 0, 0).otherwise(1).alias("label"))
    cols.append(F.when(k % 5 == 4, "validation").otherwise("train").alias("split"))
    return full.select(*cols)


_MEMO = {}


def _remember(kind, spark, sf_dir, make):
    key = (kind, spark.sparkContext.applicationId, sf_dir)
    if key not in _MEMO:
        _MEMO[key] = make()
    return _MEMO[key]


def raw_pages(spark, sf_dir):
    return _remember("raw_pages", spark, sf_dir, lambda: written(build_raw_pages(spark, sf_dir), "raw-pages"))


def line_stats(spark, sf_dir):
    return _remember(
        "line", spark, sf_dir, lambda: FT.fit(raw_lineitem(spark, sf_dir).filter(TRAIN), LINE_SPEC)
    )


def page_stats(spark, sf_dir):
    return _remember("page", spark, sf_dir, lambda: FT.fit(raw_pages(spark, sf_dir).filter(TRAIN)))


def _raw_pages_sql():
    inner = f"""
      SELECT p.*, u.* EXCLUDE (page_id) FROM ({ALL_PAGE_SQL}) p JOIN (
        SELECT page_id, domain AS "Domain", tld AS "TLD", {', '.join(f'{e} AS "{f}"' for f, e in SQL_EXPR.items())}
        FROM (SELECT *, {TLD_SQL} AS tld FROM (SELECT page_id, url, regexp_extract(url, '{AUTH}', 1) AS domain FROM pages))
      ) u USING (page_id)
    """
    cols = ["page_id AS id", 'CASE WHEN page_id % 10 >= 3 THEN url END AS "URL"',
            'CASE WHEN page_id % 2 = 1 THEN "Domain" END AS "Domain"']
    for c in ("TLD", "Title", *C.FEATURES):
        if c in RECORDED:
            m, n, d = RECORDED[c]
            value = f"(page_id * {m} % {n}) / {d!r}::DOUBLE"
        else:
            value = q(c) if c in C.TEXT else f"CAST({q(c)} AS DOUBLE)"
        cols.append(f"CASE WHEN NOT ({hole_sql('page_id', *_pattern(c))}) THEN {value} END AS {q(c)}")
    cols.append("CAST(CASE WHEN page_id % 13 = 0 THEN 0 ELSE 1 END AS INTEGER) AS label")
    cols.append("CASE WHEN page_id % 5 = 4 THEN 'validation' ELSE 'train' END AS split")
    return f"SELECT {', '.join(cols)} FROM ({inner})"


RAW_PAGES_SQL = _raw_pages_sql()


def _page_ctes():
    """Derived columns: each fills the recorded value's hole from URL, domain, TLD or title."""
    named = {f: e for f, e in SQL_EXPR.items()}
    rep = {}
    over_url = [f for f in named if f not in ("DomainLength", "IsDomainIP", "TLDLength", "NoOfSubDomain",
                                              "ObfuscationRatio", "LetterRatioInURL", "HasObfuscation")]
    d1 = ", ".join(
        f"coalesce({q(f)}, CASE WHEN url IS NOT NULL THEN CAST({named[f]} AS DOUBLE) END) AS {q(f)}" for f in over_url
    )
    obf = f"CASE WHEN coalesce(\"HasObfuscation\", CASE WHEN url IS NOT NULL THEN {named['HasObfuscation']} END) = 1 THEN 1e0 ELSE 0e0 END"
    pre = f"""
    freq AS (SELECT c AS ch, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS p FROM (
        SELECT unnest(string_split(lower("URL"), '')) AS c FROM tr WHERE "URL" IS NOT NULL)
      WHERE regexp_matches(c, '^[\\p{{L}}\\p{{N}}]$') GROUP BY c),
    cprob AS (SELECT id, sum(coalesce(p, 0)) / any_value(n) AS cp FROM (
        SELECT id, length("URL") AS n, unnest(string_split(lower("URL"), '')) AS ch FROM raw) LEFT JOIN freq USING (ch) GROUP BY id),
    dom1 AS (SELECT * REPLACE (coalesce("Domain", CASE WHEN "URL" IS NOT NULL THEN regexp_extract("URL", '{AUTH}', 1) END) AS "Domain") FROM raw),
    dom2 AS (SELECT *, "Domain" AS domain_, coalesce("TLD", {TLD_SQL.replace('domain', '"Domain"')}) AS tld2,
        coalesce("HasTitle", CASE WHEN "Title" IS NOT NULL THEN 1e0 END) AS ht FROM dom1),
    scores AS ({title_score_sql('"Domain"', '"URL"', '"Title"', 'SELECT * FROM dom2', 'id')}),
    derived AS MATERIALIZED (
      SELECT * REPLACE (
        coalesce("ObfuscationRatio", CASE WHEN "URLLength" > 0 THEN "NoOfObfuscatedChar" / "URLLength" END) AS "ObfuscationRatio",
        coalesce("LetterRatioInURL", CASE WHEN "URLLength" > 0 THEN "NoOfLettersInURL" / "URLLength" END) AS "LetterRatioInURL",
        coalesce("DomainLength", CAST(length("Domain") AS DOUBLE)) AS "DomainLength",
        coalesce("IsDomainIP", CAST({named['IsDomainIP'].replace('domain', '"Domain"')} AS DOUBLE)) AS "IsDomainIP",
        coalesce("TLDLength", CAST(length(tld2) AS DOUBLE)) AS "TLDLength",
        coalesce("NoOfSubDomain", CAST({named['NoOfSubDomain'].replace('domain', '"Domain"')} AS DOUBLE)) AS "NoOfSubDomain",
        tld2 AS "TLD", ht AS "HasTitle",
        coalesce("URLCharProb", cp) AS "URLCharProb",
        coalesce("DomainTitleMatchScore", dscore) AS "DomainTitleMatchScore",
        coalesce("URLTitleMatchScore", uscore) AS "URLTitleMatchScore")
      FROM (SELECT * REPLACE ({d1}, {obf} AS "HasObfuscation") FROM (SELECT *, "URL" AS url_ FROM dom2))
      LEFT JOIN cprob USING (id) LEFT JOIN scores USING (id))
    """
    return fit_ctes(FT.PAGE_SPEC, RAW_PAGES_SQL, pre=pre)


LINE_CTES = fit_ctes(LINE_SPEC, RAW_LINEITEM_SQL)
PAGE_CTES = _page_ctes()


def _unpivot_sql(ctes, cols, src, pattern, name="column_name"):
    """One row per column from a one-row table."""
    parts = [f"SELECT '{c}' AS {name}, {', '.join(p.format(c=c) for p in pattern)} FROM {src}" for c in cols]
    return ctes + "\n" + " UNION ALL ".join(parts)


def _rows(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# --- statistics ------------------------------------------------------------------------------

@query("category_means", f"WITH raw AS ({RAW_LINEITEM_SQL}) SELECT month, round(avg(month_share), 9) AS mean_share FROM raw "
       "WHERE split = 'train' AND month IS NOT NULL GROUP BY month")
def category_means(spark, sf_dir):
    rows = raw_lineitem(spark, sf_dir).filter(TRAIN)
    means = FT.category_means(rows, "month", "month_share")
    return means.select("month", F.round("category_mean", 9).alias("mean_share"))


@query("tld_means", f"WITH raw AS ({RAW_PAGES_SQL}) SELECT \"TLD\", round(avg(\"TLDLegitimateProb\"), 9) AS mean_share "
       "FROM raw WHERE \"TLD\" IS NOT NULL GROUP BY 1 HAVING avg(\"TLDLegitimateProb\") IS NOT NULL")
def tld_means(spark, sf_dir):
    means = FT.category_means(raw_pages(spark, sf_dir), "TLD", "TLDLegitimateProb")
    return means.select("TLD", F.round("category_mean", 9).alias("mean_share"))


@query("category_global_fill", f"WITH raw AS ({RAW_LINEITEM_SQL}) SELECT round(CASE WHEN abs(skewness(month_share)) > 1 "
       "THEN median(month_share) ELSE avg(month_share) END, 9) AS fill, round(skewness(month_share), 6) AS skew, "
       "CASE WHEN abs(skewness(month_share)) > 1 THEN 'median' ELSE 'mean' END AS method FROM raw WHERE split = 'train'")
def category_global_fill(spark, sf_dir):
    found = FT.central_fill(raw_lineitem(spark, sf_dir).filter(TRAIN), ["month_share"], 1.0)["month_share"]
    return _rows(spark, [(found.value, found.skew, found.method)], "fill double, skew double, method string").select(
        F.round("fill", 9).alias("fill"), F.round("skew", 6).alias("skew"), "method"
    )


@query("skewness", f"WITH raw AS ({RAW_LINEITEM_SQL}) SELECT label, "
       + ", ".join(f"round(skewness({c}), 6) AS {c}" for c in LINE_NUMERIC) + " FROM raw GROUP BY label")
def skewness(spark, sf_dir):
    return raw_lineitem(spark, sf_dir).groupBy("label").agg(
        *[F.round(sample_skewness(c), 6).alias(c) for c in LINE_NUMERIC]
    )


def _fill_rows(spark, fills):
    return _rows(
        spark, [(c, f.method, f.value, f.skew) for c, f in fills.items()],
        "column_name string, method string, value double, skew double",
    ).select("column_name", "method", F.round("value", 6).alias("value"), F.round("skew", 5).alias("skew"))


_FILL_COLS = ("CASE WHEN abs(skewness(\"{c}\")) > 3 THEN 'median' ELSE 'mean' END AS method",
              "round(CASE WHEN abs(skewness(\"{c}\")) > 3 THEN median(\"{c}\") ELSE avg(\"{c}\") END, 6) AS value",
              "round(skewness(\"{c}\"), 5) AS skew")


@query("numeric_fill", _unpivot_sql(LINE_CTES, LINE_SPEC.numeric, "staged_all WHERE split = 'train'", _FILL_COLS))
def numeric_fill(spark, sf_dir):
    return _fill_rows(spark, line_stats(spark, sf_dir).numeric_fill)


@query("numeric_fill_pages", _unpivot_sql(PAGE_CTES, C.NUMERIC, "staged_all WHERE split = 'train'", _FILL_COLS))
def numeric_fill_pages(spark, sf_dir):
    return _fill_rows(spark, page_stats(spark, sf_dir).numeric_fill)


@query("group_mode", f"SELECT l_returnflag, l_linestatus, l_quantity AS mode FROM (SELECT l_returnflag, l_linestatus, l_quantity, "
       "row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY count(*) DESC, l_quantity) AS rn FROM lineitem "
       "GROUP BY l_returnflag, l_linestatus, l_quantity) WHERE rn = 1")
def group_mode(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return FT.group_modes(rows, ["l_returnflag", "l_linestatus"], "l_quantity")


def _modes_sql(ctes, spec):
    on, parts = list(spec.cascade_key), []
    for i, c in enumerate(spec.cascade_order, start=1):
        key = " || '|' || ".join(f"printf('%.1f', {q(k)})" for k in on) + " || '|'"
        parts.append(f"SELECT CAST({i} AS INTEGER) AS step, {key} AS key, CAST(md AS DOUBLE) AS mode FROM m{i}")
        on.append(c)
    return ctes + "\n" + " UNION ALL ".join(parts)


@query("cascade_modes", _modes_sql(LINE_CTES, LINE_SPEC))
def cascade_modes(spark, sf_dir):
    return FT.modes_table(line_stats(spark, sf_dir), spark).select("step", "key", "mode")


@query("cascade_modes_pages", _modes_sql(PAGE_CTES, FT.PAGE_SPEC))
def cascade_modes_pages(spark, sf_dir):
    return FT.modes_table(page_stats(spark, sf_dir), spark).select("step", "key", "mode")


def _global_sql(ctes, spec):
    return ctes + "\n" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(gm AS DOUBLE) AS mode FROM g{i}"
        for i, c in enumerate(spec.cascade_order, start=1)
    )


@query("cascade_global_modes", _global_sql(PAGE_CTES, FT.PAGE_SPEC))
def cascade_global_modes(spark, sf_dir):
    return _rows(spark, list(page_stats(spark, sf_dir).global_modes.items()), "column_name string, mode double")


_CLIP = ("round(quantile_cont(\"{c}\", 0.01), 6) AS lower", "round(quantile_cont(\"{c}\", 0.99), 6) AS upper")


def _clip_rows(spark, clip):
    return _rows(spark, [(c, lo, hi) for c, (lo, hi) in clip.items()], "column_name string, lower double, upper double").select(
        "column_name", F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper")
    )


@query("clip_bounds", _unpivot_sql(LINE_CTES, LINE_SPEC.numeric, "s3 WHERE split = 'train'", _CLIP))
def clip_bounds(spark, sf_dir):
    return _clip_rows(spark, line_stats(spark, sf_dir).clip)


@query("clip_bounds_pages", _unpivot_sql(PAGE_CTES, C.NUMERIC, "s18 WHERE split = 'train'", _CLIP))
def clip_bounds_pages(spark, sf_dir):
    return _clip_rows(spark, page_stats(spark, sf_dir).clip)


@query("exact_quantiles", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({p} AS DOUBLE) AS prob, round(quantile_cont({c}, {p}), 6) AS value FROM lineitem"
    for c in ("l_quantity", "l_extendedprice", "l_discount") for p in (0.01, 0.25, 0.5, 0.75, 0.99)))
def exact_quantiles_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    found = exact_quantiles(rows, ["l_quantity", "l_extendedprice", "l_discount"], probs)
    flat = [(c, p, v) for c, vs in found.items() for p, v in zip(probs, vs, strict=True)]
    return _rows(spark, flat, "column_name string, prob double, value double").withColumn("value", F.round("value", 6))


@query("quantiles_of_holes", "SELECT 'holes' AS column_name, quantile_cont(CASE WHEN l_linenumber > 2 THEN l_quantity END, 0.3) AS value FROM lineitem "
       "UNION ALL SELECT 'nothing', NULL")
def quantiles_of_holes(spark, sf_dir):
    """A column with NULLs and one without any value, by brackets."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.when(F.col("l_linenumber") > 2, F.col("l_quantity")).alias("holes"), F.lit(None).cast("double").alias("nothing")
    )
    found = exact_quantiles(rows, ["holes", "nothing"], [0.3], small_cells=0, inside_rows=1000)
    return _rows(spark, [(c, v[0]) for c, v in found.items()], "column_name string, value double")


@query("integral_cut", LINE_CTES + f" SELECT {', '.join(LINE_KEY)}, quantity, is_return, is_open, is_large, is_deal FROM clipped")
def integral_cut(spark, sf_dir):
    prepared = TR.prepare(raw_lineitem(spark, sf_dir), line_stats(spark, sf_dir))
    return prepared.select(*LINE_KEY, "quantity", "is_return", "is_open", "is_large", "is_deal")


_SCALE = ("round(\"m_{c}\", 6) AS mean", "round(\"d_{c}\", 6) AS scale")


def _scale_rows(spark, scale):
    return _rows(spark, [(c, m, s) for c, (m, s) in scale.items()], "column_name string, mean double, scale double").select(
        "column_name", F.round("mean", 6).alias("mean"), F.round("scale", 6).alias("scale")
    )


@query("scaler", _unpivot_sql(LINE_CTES, LINE_SPEC.numeric, "sc", _SCALE))
def scaler(spark, sf_dir):
    return _scale_rows(spark, line_stats(spark, sf_dir).scale)


@query("scaler_pages", _unpivot_sql(PAGE_CTES, C.NUMERIC, "sc", _SCALE))
def scaler_pages(spark, sf_dir):
    return _scale_rows(spark, page_stats(spark, sf_dir).scale)


def _unusable_sql(ctes, spec):
    parts = []
    for c in spec.features:
        empty = " OR ".join(
            f"count(*) FILTER (WHERE {q(c)} = {v} AND label = {y}) = 0" for v in (0, 1) for y in (0, 1)
        ) if c in spec.binary else "false"
        parts.append(
            f"SELECT '{c}' AS column_name, CASE WHEN {empty} THEN 'empty_contingency_cell' "
            f"WHEN min({q(c)}) = max({q(c)}) THEN 'zero_std' END AS reason FROM clipped WHERE split = 'train'"
        )
    return ctes + " SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE reason IS NOT NULL"


@query("unusable_columns", _unusable_sql(LINE_CTES, LINE_SPEC))
def unusable_columns(spark, sf_dir):
    return _rows(spark, list(line_stats(spark, sf_dir).unusable.items()), "column_name string, reason string")


@query("unusable_columns_pages", _unusable_sql(PAGE_CTES, FT.PAGE_SPEC))
def unusable_columns_pages(spark, sf_dir):
    return _rows(spark, list(page_stats(spark, sf_dir).unusable.items()), "column_name string, reason string")


def _fallback_sql(ctes, spec):
    parts = []
    for c in spec.fallback:
        if c in spec.numeric:
            parts.append(
                f"SELECT '{c}' AS column_name, round(CASE WHEN abs(skewness({q(c)})) > 3 THEN median({q(c)}) ELSE avg({q(c)}) END, 6) AS value, "
                f"CASE WHEN abs(skewness({q(c)})) > 3 THEN 'numeric_median' ELSE 'numeric_mean' END AS source "
                "FROM staged_all WHERE split = 'train'"
            )
        else:
            i = spec.cascade_order.index(c) + 1
            parts.append(f"SELECT '{c}' AS column_name, CAST(gm AS DOUBLE) AS value, 'categorical_mode' AS source FROM g{i}")
    return ctes + " " + " UNION ALL ".join(parts)


@query("fallbacks", _fallback_sql(PAGE_CTES, FT.PAGE_SPEC))
def fallbacks(spark, sf_dir):
    rows = FT.fallback_rows(page_stats(spark, sf_dir))
    return _rows(spark, rows, "column_name string, value double, source string").withColumn("value", F.round("value", 6))


@query("train_rows", f"SELECT count(*) AS n_train_rows FROM ({RAW_LINEITEM_SQL}) WHERE split = 'train'")
def train_rows(spark, sf_dir):
    return raw_lineitem(spark, sf_dir).filter(TRAIN).agg(F.count("*").alias("n_train_rows"))


# --- transform ---------------------------------------------------------------------------------

def _round_sql(cols, spec):
    return ", ".join(
        f"round({q(c)}, 6) + 0.0 AS {q(c)}" if c in spec.numeric else f"{q(c)}" for c in cols
    )


def _rounded(df, spec):
    return df.withColumns({c: F.round(c, 6) for c in spec.numeric})


@query("record_fill_pages", PAGE_CTES + " SELECT id, " + ", ".join(
    f"round({q(c)}, 6) AS {q(c)}" for c in C.URL_FEATURES + C.TITLE_FEATURES) + " FROM staged_all")
def record_fill_pages(spark, sf_dir):
    staged = FT.stage_records(raw_pages(spark, sf_dir), page_stats(spark, sf_dir))
    return staged.select("id", *[F.round(c, 6).alias(c) for c in C.URL_FEATURES + C.TITLE_FEATURES])


@query("numeric_impute", LINE_CTES + f" SELECT {', '.join(LINE_KEY)}, {_round_sql(LINE_SPEC.numeric, LINE_SPEC)} FROM s0")
def numeric_impute(spark, sf_dir):
    stats = line_stats(spark, sf_dir)
    staged = FT.stage_records(raw_lineitem(spark, sf_dir), stats)
    return _rounded(FT.fill_numeric(staged, stats.numeric_fill), LINE_SPEC).select(*LINE_KEY, *LINE_SPEC.numeric)


@query("cascade_replay", LINE_CTES + f" SELECT {', '.join(LINE_KEY)}, is_return, is_open, is_large, is_deal FROM s3")
def cascade_replay(spark, sf_dir):
    filled = TR.fill_records(raw_lineitem(spark, sf_dir), line_stats(spark, sf_dir))
    return filled.select(*LINE_KEY, *LINE_BINARY)


def _misses_sql(ctes, spec):
    last = f"s{len(spec.cascade_order)}"
    return ctes + " " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {q('missed_' + c)}) AS BIGINT) AS misses FROM {last} "
        "WHERE split = 'validation'" for c in spec.cascade_order
    )


@query("cascade_misses", _misses_sql(PAGE_CTES, FT.PAGE_SPEC))
def cascade_misses(spark, sf_dir):
    rows = raw_pages(spark, sf_dir).filter(F.col("split") == "validation")
    return TR.cascade_misses(rows, page_stats(spark, sf_dir))


@query("clip_values", LINE_CTES + f" SELECT {', '.join(LINE_KEY)}, {_round_sql(('price', 'discount', 'tax'), LINE_SPEC)} FROM clipped")
def clip_values(spark, sf_dir):
    prepared = TR.prepare(raw_lineitem(spark, sf_dir), line_stats(spark, sf_dir))
    return prepared.select(*LINE_KEY, *[F.round(c, 6).alias(c) for c in ("price", "discount", "tax")])


@query("transform_lineitem", LINE_CTES + f" SELECT {', '.join(LINE_KEY)}, label, {_round_sql(LINE_SPEC.features, LINE_SPEC)} FROM scaled")
def transform_lineitem(spark, sf_dir):
    return _rounded(TR.transform(raw_lineitem(spark, sf_dir), line_stats(spark, sf_dir), ["label"]), LINE_SPEC)


@query("transform_pages", PAGE_CTES + f" SELECT id, {_round_sql(C.FEATURES, FT.PAGE_SPEC)} FROM scaled")
def transform_pages(spark, sf_dir):
    out = TR.transform(raw_pages(spark, sf_dir), page_stats(spark, sf_dir))
    return _rounded(C.to_feature_order(out, ("id",)), FT.PAGE_SPEC)


@query("transform_vector", LINE_CTES + f" SELECT {', '.join(LINE_KEY)}, "
       f"list_transform([{', '.join(f'{c}::DOUBLE' for c in LINE_SPEC.features)}], lambda x: round(x::FLOAT::DOUBLE, 4) + 0.0) AS v FROM scaled")
def transform_vector(spark, sf_dir):
    out = TR.to_vector(TR.transform(raw_lineitem(spark, sf_dir), line_stats(spark, sf_dir)), LINE_SPEC.features)
    return out.select(*LINE_KEY, F.transform("features", lambda x: F.round(x.cast("double"), 4) + F.lit(0.0)).alias("v"))


def _leaky_sql():
    std = ", ".join(
        f"round(({c} - avg({c}) OVER w) / (CASE WHEN min({c}) OVER w = max({c}) OVER w THEN 1 ELSE stddev_pop({c}) OVER w END), 5) + 0.0 AS {c}"
        for c in LINE_SPEC.numeric
    )
    return LINE_CTES + f" SELECT {', '.join(LINE_KEY)}, split, {std} FROM scaled WINDOW w AS (PARTITION BY split)"


@query("transform_leaky", _leaky_sql())
def transform_leaky(spark, sf_dir):
    rows, stats = raw_lineitem(spark, sf_dir), line_stats(spark, sf_dir)
    parts = [
        TR.transform_leaky(rows.filter(F.col("split") == s), stats, ["split"]) for s in ("train", "validation")
    ]
    both = parts[0].unionByName(parts[1])
    return both.select(*LINE_KEY, "split", *[F.round(c, 5).alias(c) for c in LINE_SPEC.numeric])
