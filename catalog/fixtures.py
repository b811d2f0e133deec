"""Inputs the registered queries derive from the given tables, and their SQL twins.

All holes, labels and fragments come from arithmetic on keys so that Spark and
DuckDB build the same rows. Nothing is sampled or cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlsift.runtime import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hole(key, step: int, shift: int):
    """True where a value is taken out: about 30 % of keys, its own pattern per column."""
    return (key * step + shift) % 97 < 29


def hole_sql(key: str, step: int, shift: int) -> str:
    return f"(({key}) * {step} + {shift}) % 97 < 29"


# --- pages with fragments that exercise every page feature --------------------

# Fragments appended by page_id % 8.
FRAGMENTS = (
    "",
    '<form action="/login" method="post"><input type="hidden" name="t" value="1">'
    '<input type="password" name="p"><input type="submit" value="Go"></form>',
    '<form action="https://evil.test/x"><button>Send</button></form>',
    '<img src="/a.png"><img src="https://cdn.example.org/b.png"><iframe src="https://frames.test/f"></iframe>',
    '<a href="https://www.facebook.com/page">f</a><a href="https://partner.co.uk/x">p</a>'
    '<a href="#">top</a><a href="mailto:a@b.test">m</a><a>none</a>',
    '<meta name="description" content="About us"><meta name="viewport" content="width=device-width">'
    '<link rel="shortcut icon" href="/favicon.ico"><link rel="stylesheet" href="//cdn.test/s.css">',
    '<meta http-equiv="refresh" content="5; url=/next"><meta name="robots" content="NOINDEX,follow">',
    '<p onclick="alert(1)">bank paypal wallet</p><script src="/x.js">window.open(1)</script>',
)


def pages_rich(spark, sf_dir) -> DataFrame:
    pages = spread(table(spark, sf_dir, "pages"))
    fragment = F.element_at(
        F.array(*[F.lit(x) for x in FRAGMENTS]), (F.col("page_id") % 8 + 1).cast("int")
    )
    return pages.withColumn("html", F.concat("html", fragment))


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


PAGES_RICH_SQL = f"""
  SELECT page_id, url, html || list_extract([{", ".join(_quoted(x) for x in FRAGMENTS)}],
         CAST(page_id % 8 + 1 AS BIGINT)) AS html
  FROM pages
"""

# --- line items as a generic record table -------------------------------------

LINE_KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate")
LINE_NUMERIC = ("quantity", "price", "discount", "tax")
LINE_BINARY = ("is_return", "is_open", "is_large", "is_deal")
# (column, multiplier, shift) of each hole pattern
LINE_HOLES = (
    ("quantity", 5, 11), ("price", 7, 23), ("discount", 11, 31), ("tax", 13, 41),
    ("is_open", 17, 3), ("is_large", 19, 59), ("is_deal", 23, 71), ("month", 29, 83),
    ("month_share", 31, 7),
)


def raw_lineitem(spark, sf_dir) -> DataFrame:
    t = spread(table(spark, sf_dir, "lineitem"))
    mix = (
        F.col("l_orderkey") * 31 + F.col("l_partkey") * 7 + F.col("l_suppkey") * 3
        + F.col("l_linenumber")
    )
    full = t.select(
        *LINE_KEY, mix.alias("mix"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("is_return"),
        F.when(F.col("l_linestatus") == "O", 1.0).otherwise(0.0).alias("is_open"),
        F.when(F.col("l_quantity") > 25, 1.0).otherwise(0.0).alias("is_large"),
        F.when(F.col("l_discount") > 0.05, 1.0).otherwise(0.0).alias("is_deal"),
        F.month("l_shipdate").cast("string").alias("month"),
        (F.col("l_tax") * 10 / (F.col("l_linenumber") + 1)).alias("month_share"),
        F.when(mix % 13 == 0, 0).otherwise(1).alias("label"),
        F.when(mix % 5 == 0, "validation").otherwise("train").alias("split"),
    )
    return full.withColumns(
        {c: F.when(~hole(F.col("mix"), p, q), F.col(c)) for c, p, q in LINE_HOLES}
    )


RAW_LINEITEM_SQL = f"""
  SELECT {", ".join(LINE_KEY)}, mix,
    {", ".join(f"CASE WHEN NOT ({hole_sql('mix', p, q)}) THEN {c} END AS {c}" for c, p, q in LINE_HOLES)},
    is_return, label, split
  FROM (
    SELECT *, l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax,
      CASE WHEN l_returnflag = 'R' THEN 1e0 ELSE 0e0 END AS is_return,
      CASE WHEN l_linestatus = 'O' THEN 1e0 ELSE 0e0 END AS is_open,
      CASE WHEN l_quantity > 25 THEN 1e0 ELSE 0e0 END AS is_large,
      CASE WHEN l_discount > 0.05::DOUBLE THEN 1e0 ELSE 0e0 END AS is_deal,
      CAST(month(l_shipdate) AS VARCHAR) AS month,
      l_tax * 10 / (l_linenumber + 1) AS month_share,
      CAST(CASE WHEN mix % 13 = 0 THEN 0 ELSE 1 END AS INTEGER) AS label,
      CASE WHEN mix % 5 = 0 THEN 'validation' ELSE 'train' END AS split
    FROM (SELECT *, l_orderkey * 31 + l_partkey * 7 + l_suppkey * 3 + l_linenumber AS mix FROM lineitem)
  )
"""

# --- predictions derived from line items ---------------------------------------

MODELS = ("knn_vote", "knn_library", "nb_floor", "nb_smooth")


def predictions(spark, sf_dir) -> DataFrame:
    """Four models' labels and scores with different error patterns and many equal scores."""
    rows = raw_lineitem(spark, sf_dir)
    mix = F.col("mix")
    out = rows.select(*LINE_KEY, "mix", F.col("label").alias("y_true"))
    for i, m in enumerate(MODELS):
        base = F.when(F.col("y_true") == 0, 60).otherwise(0)
        score = (base + (mix * (3 + 2 * i)) % (41 + i)) / F.lit(100.0)
        out = out.withColumn(f"{m}_score", score)
        out = out.withColumn(f"{m}_pred", F.when(F.col(f"{m}_score") >= 0.35 + 0.05 * i, 0).otherwise(1))
    return out


def _pred_sql() -> str:
    cols = []
    for i, m in enumerate(MODELS):
        score = f"((CASE WHEN label = 0 THEN 60 ELSE 0 END) + (mix * {3 + 2 * i}) % {41 + i}) / 100e0"
        cols.append(f"{score} AS {m}_score")
        cols.append(
            f"CAST(CASE WHEN {score} >= {0.35 + 0.05 * i!r}::DOUBLE THEN 0 ELSE 1 END AS INTEGER) AS {m}_pred"
        )
    return (
        f"SELECT {', '.join(LINE_KEY)}, mix, label AS y_true, {', '.join(cols)} "
        f"FROM ({RAW_LINEITEM_SQL})"
    )


PREDICTIONS_SQL = _pred_sql()
