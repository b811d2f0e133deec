"""Profiles, samples, selection scores, scalers, contract checks, sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.fit_queries import _CLIP, PAGE_CTES, RAW_PAGES_SQL, _clip_rows, _remember, _unpivot_sql, page_stats, q, raw_pages
from catalog.fixtures import (
    LINE_BINARY, LINE_KEY, LINE_NUMERIC, PAGES_RICH_SQL, RAW_LINEITEM_SQL, pages_rich, raw_lineitem, table,
)
from catalog.page_queries import ALL_PAGE_SQL
from urlsift import contract as C
from urlsift.operators import profile as PF
from urlsift.operators import sampling as S
from urlsift.operators import selection as SE
from urlsift.operators.elements import page_elements
from urlsift.operators.fit import PAGE_SPEC, central_fill, fill_numeric, fit
from urlsift.operators.page_features import page_features
from urlsift.operators import transform as TR
from urlsift.runtime import work_dir
from urlsift.sources import files, store

QUERIES, SQL = {}, {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


KEYS = ", ".join(LINE_KEY)
COLS = (*LINE_NUMERIC, "is_open", "is_large", "is_deal", "month")


def _r(df, cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


# --- profiles ---------------------------------------------------------------------------------

_NULLS = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count(*) - count({c}) AS nulls, round((count(*) - count({c})) / CAST(count(*) AS DOUBLE), 9) AS null_rate FROM raw"
    for c in COLS
)


@query("null_profile", f"WITH raw AS ({RAW_LINEITEM_SQL}) {_NULLS}")
def null_profile(spark, sf_dir):
    return _r(PF.null_profile(raw_lineitem(spark, sf_dir), COLS), ["null_rate"], 9)


@query("missing_ranking", f"WITH raw AS ({RAW_LINEITEM_SQL}) SELECT \"column\", null_rate FROM ({_NULLS})")
def missing_ranking(spark, sf_dir):
    return _r(PF.missing_ranking(raw_lineitem(spark, sf_dir), COLS), ["null_rate"], 9)


@query("median_nulls", f"WITH raw AS ({RAW_LINEITEM_SQL}) SELECT median(nulls) AS median_nulls FROM ({_NULLS})")
def median_nulls(spark, sf_dir):
    return PF.median_nulls(raw_lineitem(spark, sf_dir), COLS)


@query("null_profile_pages", f"WITH raw AS ({RAW_PAGES_SQL}) " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({q(c)}) AS nulls FROM raw" for c in C.WORKING))
def null_profile_pages(spark, sf_dir):
    return PF.null_profile(raw_pages(spark, sf_dir), C.WORKING).select("column", "nulls")


@query("class_profile", f"WITH raw AS ({RAW_LINEITEM_SQL}) SELECT label, count(*) AS n, round(count(*) / CAST((SELECT count(*) FROM raw) AS DOUBLE), 9) AS share FROM raw GROUP BY label")
def class_profile(spark, sf_dir):
    return _r(PF.class_profile(raw_lineitem(spark, sf_dir)), ["share"], 9)


@query("class_distribution", "SELECT l_returnflag AS label, count(*) AS n FROM lineitem GROUP BY 1")
def class_distribution(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("label"))
    return PF.class_profile(rows).select("label", "n")


@query("class_means", f"WITH raw AS ({RAW_LINEITEM_SQL}) SELECT label, {', '.join(f'round(avg({c}), 6) AS {c}' for c in LINE_NUMERIC)} FROM raw GROUP BY label")
def class_means(spark, sf_dir):
    return _r(PF.class_means(raw_lineitem(spark, sf_dir), LINE_NUMERIC), LINE_NUMERIC)


@query("histogram", """
  WITH e AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, (max(l_extendedprice) - min(l_extendedprice)) / 30 AS w FROM lineitem),
  b AS (SELECT CAST(least(greatest(ceil((l_extendedprice - lo) / w), 1), 30) AS INTEGER) AS bin,
    (l_orderkey * 31 + l_partkey * 7 + l_suppkey * 3 + l_linenumber) % 13 = 0 AS phish FROM lineitem, e)
  SELECT bin, round(((CASE WHEN bin = 1 THEN lo - 0.001 * (hi - lo) ELSE lo + (bin - 1) * w END) + lo + bin * w) / 2, 4) AS middle,
    count(*) FILTER (WHERE phish) AS phishing, count(*) FILTER (WHERE NOT phish) AS legitimate FROM b, e GROUP BY bin, lo, hi, w""")
def histogram(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    mix = F.expr("l_orderkey * 31 + l_partkey * 7 + l_suppkey * 3 + l_linenumber")
    marked = rows.withColumn("label", F.when(mix % 13 == 0, 0).otherwise(1))
    return _r(PF.histogram(marked, "l_extendedprice"), ["middle"], 4)


@query("top_values", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 30")
def top_values(spark, sf_dir):
    return PF.top_values(table(spark, sf_dir, "lineitem"), "l_partkey", 30)


def _outlier_sql(c):
    return f"""SELECT '{c}' AS feature, count(*) FILTER (WHERE CASE WHEN sk THEN {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)
      ELSE abs(({c} - m) / sd) > 3 END) AS outliers, CASE WHEN any_value(sk) THEN 'IQR' ELSE 'Z-Score' END AS method
      FROM t, (SELECT abs(skewness({c})) > 3 AS sk, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, avg({c}) AS m, stddev_pop({c}) AS sd FROM t)"""


_OUT_SQL = "SELECT l_extendedprice AS price, l_discount AS discount, pow(l_extendedprice / 10000, 9) AS heavy, CASE WHEN l_orderkey % 50 = 0 THEN 40e0 ELSE l_tax END AS spiked FROM lineitem"


@query("outliers", f"WITH t AS ({_OUT_SQL}) " + " UNION ALL ".join(_outlier_sql(c) for c in ("price", "discount", "heavy", "spiked")))
def outliers(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("discount"),
        F.pow(F.col("l_extendedprice") / 10000, 9).alias("heavy"),
        F.when(F.col("l_orderkey") % 50 == 0, 40.0).otherwise(F.col("l_tax")).alias("spiked"),
    )
    return PF.outliers(rows, ["price", "discount", "heavy", "spiked"])


@query("range_columns", f"WITH raw AS ({RAW_LINEITEM_SQL}) SELECT c AS column_name FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS c, min({c}) AS lo, max({c}) AS hi FROM raw" for c in LINE_NUMERIC) + ") WHERE lo >= 0 AND hi <= 1000")
def range_columns(spark, sf_dir):
    names = PF.columns_in_range(raw_lineitem(spark, sf_dir), LINE_NUMERIC, 0, 1000)
    return spark.createDataFrame([(c,) for c in names], "column_name string")


@query("log_form", f"SELECT {KEYS}, {', '.join(f'round(ln(1 + {c}), 6) AS {c}' for c in ('quantity', 'discount', 'tax'))} FROM ({RAW_LINEITEM_SQL})")
def log_form(spark, sf_dir):
    return _r(PF.log_form(raw_lineitem(spark, sf_dir), LINE_NUMERIC, LINE_KEY), ["quantity", "discount", "tax"])


@query("sqrt_form", f"SELECT {KEYS}, round(sqrt(discount), 6) AS discount, round(sqrt(tax), 6) AS tax FROM ({RAW_LINEITEM_SQL})")
def sqrt_form(spark, sf_dir):
    return _r(PF.sqrt_form(raw_lineitem(spark, sf_dir), LINE_NUMERIC, LINE_KEY), ["discount", "tax"])


def _over_raw(exprs):
    return (
        f"WITH raw AS ({RAW_LINEITEM_SQL}) SELECT {KEYS}, {', '.join(exprs)} FROM raw, (SELECT "
        + ", ".join(
            f"min({c}) AS lo_{c}, max({c}) AS hi_{c}, avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}, quantile_cont({c}, [0.01, 0.25, 0.5, 0.75, 0.99]) AS q_{c}"
            for c in LINE_NUMERIC) + " FROM raw)"
    )


def _numeric(fn):
    def run(spark, sf_dir):
        return _r(fn(raw_lineitem(spark, sf_dir), LINE_NUMERIC), LINE_NUMERIC).select(*LINE_KEY, *LINE_NUMERIC)

    return run


for _name, _fn, _expr in (
    ("percentile_clip", PF.percentile_clip, "round(CASE WHEN {c} IS NOT NULL THEN greatest(least({c}, q_{c}[5]), q_{c}[1]) END, 6) AS {c}"),
    ("min_max_scale", PF.min_max_scale, "round(({c} - lo_{c}) / (hi_{c} - lo_{c}), 6) AS {c}"),
    ("robust_scale", PF.robust_scale, "round(({c} - q_{c}[3]) / (q_{c}[4] - q_{c}[2]), 6) AS {c}"),
    ("standard_scale", PF.standard_scale, "round(({c} - m_{c}) / s_{c}, 6) AS {c}"),
):
    QUERIES[_name] = _numeric(_fn)
    SQL[_name] = _over_raw([_expr.format(c=c) for c in LINE_NUMERIC])

_DUP = "l_partkey % 50, l_linenumber, l_returnflag"


@query("duplicates", f"SELECT count(*) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT l_partkey % 50, l_linenumber, l_returnflag FROM lineitem)) AS n_distinct, "
       "count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_partkey % 50, l_linenumber, l_returnflag FROM lineitem)) AS duplicates FROM lineitem")
def duplicates(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 50).alias("p"), "l_linenumber", "l_returnflag")
    return PF.duplicate_count(rows)


@query("deduplicated", "SELECT DISTINCT l_partkey % 50 AS p, l_linenumber, l_returnflag FROM lineitem")
def deduplicated(spark, sf_dir):
    return PF.deduplicated(table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 50).alias("p"), "l_linenumber", "l_returnflag"))


_COPIED = "SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 7 = 0 UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 21 = 0"


def _copied(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return rows.union(rows.filter("l_orderkey % 7 = 0")).union(rows.filter("l_orderkey % 21 = 0"))


@query("duplicate_rows", f"SELECT (SELECT count(*) FROM ({_COPIED})) AS n_rows, count(*) AS n_distinct, (SELECT count(*) FROM ({_COPIED})) - count(*) AS duplicates FROM (SELECT DISTINCT * FROM ({_COPIED}))")
def duplicate_rows(spark, sf_dir):
    """Copies of whole line items."""
    return PF.duplicate_count(_copied(spark, sf_dir))


@query("deduplicated_rows", f"SELECT l_returnflag, count(*) AS n, sum(l_orderkey)::BIGINT AS keys FROM (SELECT DISTINCT * FROM ({_COPIED})) GROUP BY 1")
def deduplicated_rows(spark, sf_dir):
    found = PF.deduplicated(_copied(spark, sf_dir))
    return found.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("keys"))


@query("derived_features", f"SELECT page_id, \"NoOfPopup\" + \"NoOfiFrame\" AS \"NoOfPops\", \"NoOfSelfRef\" + \"NoOfEmptyRef\" + \"NoOfExternalRef\" AS \"NoOfHref\", "
       f"CAST(CASE WHEN \"HasCopyrightInfo\" = 1 OR \"HasSocialNet\" = 1 THEN 1 ELSE 0 END AS INTEGER) AS \"HasSolidInfo\" FROM ({ALL_PAGE_SQL})")
def derived_features(spark, sf_dir):
    page = page_features(pages_rich(spark, sf_dir))
    return PF.derived_features(page).select("page_id", "NoOfPops", "NoOfHref", "HasSolidInfo")


# --- selection ----------------------------------------------------------------------------------

def _filled(spark, sf_dir):
    return raw_lineitem(spark, sf_dir).fillna(0.0, [*LINE_BINARY, *LINE_NUMERIC])


_FILLED_SQL = f"SELECT label, {', '.join(f'coalesce({c}, 0) AS {c}' for c in (*LINE_BINARY, *LINE_NUMERIC))} FROM ({RAW_LINEITEM_SQL})"
_CHI2 = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, sum(pow(o - e, 2) / e) AS score FROM (SELECT sum({c}) AS o, (SELECT sum({c}) FROM t) * count(*) / (SELECT count(*) FROM t) AS e FROM t GROUP BY label)"
    for c in LINE_BINARY
)
_ANOVA = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, (sum(n * pow(m - g, 2)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))) AS score FROM "
    f"(SELECT count(*) AS n, avg({c}) AS m, var_pop({c}) AS v, (SELECT avg({c}) FROM t) AS g FROM t GROUP BY label)" for c in LINE_NUMERIC
)


@query("chi2", f"WITH t AS ({_FILLED_SQL}) SELECT feature, round(score, 5) AS score FROM ({_CHI2})")
def chi2(spark, sf_dir):
    return _r(SE.chi2_scores(_filled(spark, sf_dir), LINE_BINARY), ["score"], 5)


@query("anova_f", f"WITH t AS ({_FILLED_SQL}) SELECT feature, round(score, 5) AS score FROM ({_ANOVA})")
def anova_f(spark, sf_dir):
    return _r(SE.anova_f_scores(_filled(spark, sf_dir), LINE_NUMERIC), ["score"], 5)


@query("selected_features", f"WITH t AS ({_FILLED_SQL}) SELECT DISTINCT feature FROM (SELECT * FROM (SELECT feature FROM ({_CHI2}) ORDER BY score DESC, feature LIMIT 2) "
       f"UNION ALL SELECT * FROM (SELECT feature FROM ({_ANOVA}) ORDER BY score DESC, feature LIMIT 3))")
def selected_features(spark, sf_dir):
    return SE.select_features(_filled(spark, sf_dir), LINE_BINARY, LINE_NUMERIC, k_binary=2, k_numeric=3)


# --- samples -----------------------------------------------------------------------------------------

_ORDER = "mix * 7919 % 100003, mix, " + KEYS


def _order():
    return [F.col("mix") * 7919 % 100003, "mix", *LINE_KEY]


@query("hash_split", "SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN CAST('0x' || substr(md5(concat_ws('|', l_orderkey::VARCHAR, "
       "l_partkey::VARCHAR, l_linenumber::VARCHAR, '42')), 1, 8) AS BIGINT) % 1000000 < 800000 THEN 'train' ELSE 'validation' END AS split FROM lineitem")
def hash_split(spark, sf_dir):
    """Train or validation by key hash."""
    keys = ["l_orderkey", "l_partkey", "l_linenumber"]
    return S.hash_split(table(spark, sf_dir, "lineitem"), keys).select(*keys, "split")


@query("arithmetic_split", f"SELECT split, count(*) AS n FROM ({RAW_LINEITEM_SQL}) GROUP BY split")
def arithmetic_split(spark, sf_dir):
    return raw_lineitem(spark, sf_dir).groupBy("split").agg(F.count("*").alias("n"))


@query("stratified_sample", f"SELECT {KEYS}, label FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {_ORDER}) AS rn FROM ({RAW_LINEITEM_SQL})) "
       "WHERE rn <= CASE label WHEN 0 THEN 400 ELSE 1600 END")
def stratified_sample(spark, sf_dir):
    rows = raw_lineitem(spark, sf_dir).select(*LINE_KEY, "mix", "label")
    return S.sample_per_stratum(rows, "label", {0: 400, 1: 1600}, _order()).select(*LINE_KEY, "label")


@query("four_strata", f"""SELECT id, stratum FROM (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY id * 31 % 101, id) AS rn FROM (
  SELECT id, CASE WHEN "URL" IS NULL THEN 'url_missing' WHEN "Domain" IS NULL THEN 'domain_missing_url_present' WHEN label = 0 THEN 'both_present_phishing'
  ELSE 'both_present_legitimate' END AS stratum FROM ({RAW_PAGES_SQL}))) WHERE rn <= 20""")
def four_strata(spark, sf_dir):
    return S.four_strata(raw_pages(spark, sf_dir), 80, [F.col("id") * 31 % 101, "id"]).select("id", "stratum")


@query("balanced_urls", f"""SELECT id, label FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY id * 31 % 101, id) AS rn
  FROM ({RAW_PAGES_SQL}) WHERE "URL" IS NOT NULL) WHERE rn <= 10""")
def balanced_urls(spark, sf_dir):
    return S.balanced_urls(raw_pages(spark, sf_dir), 20, [F.col("id") * 31 % 101, "id"]).select("id", "label")


@query("batch_cap", f"SELECT {KEYS} FROM lineitem ORDER BY {KEYS} LIMIT 5000")
def batch_cap(spark, sf_dir):
    return S.first_rows(table(spark, sf_dir, "lineitem").select(*LINE_KEY), LINE_KEY, 5000)


# --- contract, projections ---------------------------------------------------------------------------

@query("label_check", f"WITH t AS (SELECT CASE WHEN mix % 31 = 0 THEN NULL WHEN mix % 37 = 0 THEN 2 ELSE label END AS label FROM ({RAW_LINEITEM_SQL})) "
       "SELECT count(*) FILTER (WHERE label IS NULL) AS missing_labels, count(*) FILTER (WHERE label NOT IN (0, 1)) AS unexpected_rows, "
       "min(label) FILTER (WHERE label NOT IN (0, 1)) AS min_unexpected, max(label) FILTER (WHERE label NOT IN (0, 1)) AS max_unexpected FROM t")
def label_check(spark, sf_dir):
    k = F.col("mix")
    rows = raw_lineitem(spark, sf_dir).withColumn("label", F.when(k % 31 == 0, None).when(k % 37 == 0, 2).otherwise(F.col("label")))
    return C.label_problems(rows)


@query("working_columns", f"SELECT {', '.join(q(c) for c in C.WORKING)} FROM ({RAW_PAGES_SQL})")
def working_columns(spark, sf_dir):
    return C.split_record(raw_pages(spark, sf_dir).withColumnRenamed("id", "id").withColumn("FILENAME", F.lit("x"))).select(*C.WORKING)


@query("feature_order", f"SELECT id, {', '.join(q(c) for c in C.FEATURES)} FROM ({RAW_PAGES_SQL})")
def feature_order(spark, sf_dir):
    rows = raw_pages(spark, sf_dir)
    return C.to_feature_order(rows.select(*sorted(rows.columns)), ("id",))


@query("present_value_kept", f"SELECT id, CAST(coalesce(\"URLLength\", length(\"URL\")) AS DOUBLE) AS \"URLLength\" FROM ({RAW_PAGES_SQL})")
def present_value_kept(spark, sf_dir):
    from urlsift.functions.url import fill_url_features

    return fill_url_features(raw_pages(spark, sf_dir), None).select("id", "URLLength")


@query("class_filter", f"SELECT id, label FROM ({RAW_PAGES_SQL}) WHERE label = 0")
def class_filter(spark, sf_dir):
    return raw_pages(spark, sf_dir).filter(F.col("label") == C.PHISHING).select("id", "label")


@query("missing_text_added", f"SELECT id, CAST(NULL AS VARCHAR) AS \"Title\", CAST(NULL AS VARCHAR) AS \"TLD\", \"URL\" FROM ({RAW_PAGES_SQL})")
def missing_text_added(spark, sf_dir):
    return C.add_missing_text(raw_pages(spark, sf_dir).drop("Title", "TLD")).select("id", "Title", "TLD", "URL")


# --- batch-fitted preparation -------------------------------------------------------------------------

def _batch_sql():
    from catalog.fit_queries import LINE_SPEC
    from catalog.fit_sql import fit_ctes

    ctes = fit_ctes(LINE_SPEC, RAW_LINEITEM_SQL, train="true")
    cols = ", ".join(f"round({c}, 6) + 0.0 AS {c}" if c in LINE_SPEC.numeric else c for c in LINE_SPEC.features)
    return f"{ctes} SELECT {KEYS}, {cols} FROM scaled"


@query("batch_fitted", _batch_sql())
def batch_fitted(spark, sf_dir):
    """Fit and transform on one and the same batch (the defective form, for comparison)."""
    from catalog.fit_queries import LINE_SPEC

    rows = raw_lineitem(spark, sf_dir)
    stats = _remember("line-all", spark, sf_dir, lambda: fit(rows, LINE_SPEC))
    return _r(TR.transform(rows, stats), LINE_SPEC.numeric)


# --- sources and sinks ---------------------------------------------------------------------------------

def _path(spark, name):
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("csv_round_trip", f"SELECT id, \"URL\", \"Title\", \"URLLength\", \"CharContinuationRate\", label FROM ({RAW_PAGES_SQL})")
def csv_round_trip(spark, sf_dir):
    path = _path(spark, "csv")
    rows = raw_pages(spark, sf_dir).withColumn("FILENAME", F.concat("id", F.lit(".txt")))
    files.write_csv(rows.select(*reversed(C.RAW)), path)
    return files.read_records(spark, path).select("id", "URL", "Title", "URLLength", "CharContinuationRate", "label")


@query("parquet_round_trip", f"SELECT {KEYS}, quantity, month, label FROM ({RAW_LINEITEM_SQL})")
def parquet_round_trip(spark, sf_dir):
    path = _path(spark, "parquet")
    files.write_parquet(raw_lineitem(spark, sf_dir).select(*LINE_KEY, "quantity", "month", "label"), path)
    return files.read_parquet(spark, path)


@query("page_store", "SELECT sha1(html) AS sha1, count(*) AS n, max(length(html)) AS chars FROM (SELECT html FROM pages UNION ALL SELECT html FROM pages WHERE page_id % 3 = 0) GROUP BY 1 HAVING count(*) >= 1")
def page_store(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("html")
    doubled = pages.unionByName(table(spark, sf_dir, "pages").filter("page_id % 3 = 0").select("html"))
    hashed = doubled.withColumn("sha1", F.sha1(F.encode("html", "UTF-8")))
    copies = hashed.groupBy("sha1").agg(F.count("*").alias("n"))
    stored = files.page_store(doubled).select("sha1", F.length("html").cast("long").alias("chars"))
    return stored.join(copies, "sha1").select("sha1", "n", "chars")


@query("packed_pages", "SELECT DISTINCT sha1(html) AS sha1, length(html) AS chars FROM pages")
def packed_pages(spark, sf_dir):
    """Pages packed with gzip by content hash and unpacked again."""
    unpacked = files.unpacked_store(files.packed_store(table(spark, sf_dir, "pages")))
    return unpacked.select("sha1", F.length("html").cast("long").alias("chars"))


@query("corpus_gaps", "SELECT DISTINCT sha1(html) AS sha1, CASE WHEN page_id % 5 = 0 THEN 'page missing' ELSE 'not expected' END AS problem FROM pages WHERE page_id % 5 IN (0, 1)")
def corpus_gaps(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").withColumn("sha1", F.sha1(F.encode("html", "UTF-8")))
    return files.corpus_gaps(pages.filter("page_id % 5 <> 1").select("sha1"), pages.filter("page_id % 5 <> 0").select("sha1"))


@query("url_lines", """
  SELECT grp, CAST(rn - 1 AS INTEGER) AS line, url FROM (SELECT page_id // 40 AS grp, url, row_number() OVER (PARTITION BY page_id // 40 ORDER BY page_id) AS rn FROM pages)""")
def url_lines(spark, sf_dir):
    """Lists of up to forty addresses with blank lines between."""
    pages = table(spark, sf_dir, "pages").select(F.expr("page_id div 40").alias("grp"), "page_id", "url")
    lists = pages.groupBy("grp").agg(F.array_sort(F.collect_list(F.struct("page_id", "url"))).alias("u"))
    text = F.array_join(F.transform("u", lambda x: F.concat(F.lit("  "), x["url"], F.lit(" \n \n"))), "")
    return files.url_lines(lists.select("grp", text.alias("text")), "text", ["grp"])


@query("stats_round_trip", _unpivot_sql(PAGE_CTES, C.NUMERIC, "s18 WHERE split = 'train'", _CLIP))
def stats_round_trip(spark, sf_dir):
    """Clip bounds as they come back from the store."""
    path = _path(spark, "stats")
    store.save_stats(spark, page_stats(spark, sf_dir), path)
    return _clip_rows(spark, store.load_stats(spark, path).clip)


_EDGES = """CASE doc_id % 5 WHEN 0 THEN '  ' || text || chr(9) WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN '" ' || text || ' ,"' ELSE text || chr(10) || '  ' END"""


@query("csv_edge_values", f"SELECT doc_id, {_EDGES} AS text, CASE WHEN doc_id % 3 > 0 THEN n_chars END AS n_chars FROM documents")
def csv_edge_values(spark, sf_dir):
    """Blanks at the ends, empty and missing values, quotes and line breaks around whole documents, through the CSV sink and source."""
    path = _path(spark, "csv")
    rows = table(spark, sf_dir, "documents").selectExpr("doc_id", f"{_EDGES.replace('chr(', 'char(')} AS text", "CASE WHEN doc_id % 3 > 0 THEN n_chars END AS n_chars")
    files.write_csv(rows, path)
    return files.read_csv(spark, path, "doc_id long, text string, n_chars long")


_WHOLE = "'He said \"' || text || '\", ok' || chr(10) || lang"


@query("csv_whole_texts", f"SELECT doc_id, {_WHOLE} AS text FROM documents")
def csv_whole_texts(spark, sf_dir):
    """Whole documents between quotes, commas and line breaks through the CSV sink and source."""
    path = _path(spark, "csv")
    files.write_csv(table(spark, sf_dir, "documents").selectExpr("doc_id", f"{_WHOLE} AS text"), path)
    return files.read_csv(spark, path, "doc_id long, text string")


@query("unexpected_labels", "SELECT DISTINCT l_linenumber AS label FROM lineitem WHERE l_linenumber NOT IN (0, 1)")
def unexpected_labels(spark, sf_dir):
    """Every label outside the two classes."""
    return C.unexpected_labels(table(spark, sf_dir, "lineitem").withColumnRenamed("l_linenumber", "label"))


@query("broken_markup", "SELECT page_id, page_id % 4 AS images FROM pages")
def broken_markup(spark, sf_dir):
    """Images behind a declaration that no parser knows are counted."""
    html = F.concat(F.lit('<a href="/x">x</a><![foo[bar]]><p>text</p>'), F.expr("repeat('<img src=\"a.png\">', int(page_id % 4))"))
    pages = table(spark, sf_dir, "pages").select("page_id", html.alias("html"))
    found = page_elements(pages).groupBy("page_id").agg(F.count_if(F.col("tag") == "img").alias("images"))
    return found
