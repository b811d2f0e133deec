"""URL string features over the pages table."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.fixtures import table
from urlsift.functions import url as U
from urlsift.operators import fit, page_features
from urlsift.runtime import spread

AUTH = r"^[\x00-\x20]*(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)"
PATH = r"^[\x00-\x20]*(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"


def _n(sql: str) -> str:
    return f"CAST({sql} AS INTEGER)"


def _drop(pattern: str, col: str = "url") -> str:
    return f"length(regexp_replace({col}, '{pattern}', '', 'g'))"


# SQL of every URL feature over columns url, domain, tld (plain CASE and string functions)
SQL_EXPR = {
    "URLLength": _n("length(url)"),
    "DomainLength": _n("length(domain)"),
    "IsDomainIP": _n(
        r"CASE WHEN domain IS NULL THEN NULL WHEN regexp_matches(domain, '^(\d{1,3}\.){3}\d{1,3}$') AND "
        r"len(list_filter(string_split(domain, '.'), lambda p: TRY_CAST(p AS INTEGER) > 255)) = 0 THEN 1 ELSE 0 END"
    ),
    "CharContinuationRate": f"CASE WHEN length(url) > 0 THEN CAST({_drop('[^a-zA-Z0-9_]')} AS DOUBLE) / length(url) END",
    "TLDLength": _n("length(tld)"),
    "NoOfSubDomain": _n("CASE WHEN domain IS NOT NULL THEN greatest(len(string_split(domain, '.')) - 2, 0) END"),
    "HasObfuscation": _n(
        f"CASE WHEN length(url) - {_drop('[-_]')} > 3 OR regexp_matches(url, '[a-zA-Z]+[0-9]+|[0-9]+[a-zA-Z]+') OR "
        r"(length(url) % 4 = 0 AND regexp_matches(url, '^[A-Za-z0-9+/]*={0,2}\z')) OR "
        r"regexp_matches(url, '^[a-zA-Z0-9.\-]+$') OR NOT regexp_matches(url, '[a-zA-Z]{3,}') THEN 1 ELSE 0 END"
    ),
    "NoOfObfuscatedChar": _n(
        "len(regexp_extract_all(url, '%[0-9a-fA-F]{2}')) + length(url) - length(replace(url, '@', ''))"
    ),
    "ObfuscationRatio": (
        "CASE WHEN length(url) > 0 THEN CAST(len(regexp_extract_all(url, '%[0-9a-fA-F]{2}')) + length(url) "
        "- length(replace(url, '@', '')) AS DOUBLE) / length(url) END"
    ),
    "NoOfLettersInURL": _n(_drop(r"[^\p{L}]")),
    "LetterRatioInURL": f"CASE WHEN length(url) > 0 THEN CAST({_drop(chr(91) + '^' + chr(92) + 'p{L}]')} AS DOUBLE) / length(url) END",
    "NoOfDegitsInURL": _n(_drop(r"[^\p{Nd}]")),
    "DegitRatioInURL": f"CASE WHEN length(url) > 0 THEN CAST({_drop(chr(91) + '^' + chr(92) + 'p{Nd}]')} AS DOUBLE) / length(url) END",
    "NoOfEqualsInURL": _n("length(url) - length(replace(url, '=', ''))"),
    "NoOfQMarkInURL": _n("length(url) - length(replace(url, '?', ''))"),
    "NoOfAmpersandInURL": _n("length(url) - length(replace(url, '&', ''))"),
    "NoOfOtherSpecialCharsInURL": _n(_drop("[0-9A-Za-z]")),
    "SpacialCharRatioInURL": f"CASE WHEN length(url) > 0 THEN CAST({_drop('[0-9A-Za-z]')} AS DOUBLE) / length(url) END",
    "IsHTTPS": _n("CASE WHEN url IS NULL THEN NULL WHEN contains(url, 'https://') THEN 1 ELSE 0 END"),
}

TLD_SQL = "CASE WHEN len(string_split(domain, '.')) > 1 THEN list_extract(string_split(domain, '.'), -1) END"
STAGED_SQL = f"""
  SELECT *, {TLD_SQL} AS tld FROM (
    SELECT page_id, url, html, regexp_extract(url, '{AUTH}', 1) AS domain FROM pages)
"""

NAMES = {
    "URLLength": "url_length", "DomainLength": "url_domain_length", "IsDomainIP": "url_is_ip",
    "CharContinuationRate": "url_continuation_rate", "TLDLength": "url_tld_length",
    "NoOfSubDomain": "url_subdomains", "HasObfuscation": "url_obfuscation",
    "NoOfObfuscatedChar": "url_obfuscated_chars", "ObfuscationRatio": "url_obfuscation_ratio",
    "NoOfLettersInURL": "url_letters", "LetterRatioInURL": "url_letter_ratio",
    "NoOfDegitsInURL": "url_digits", "DegitRatioInURL": "url_digit_ratio",
    "NoOfEqualsInURL": "url_equals", "NoOfQMarkInURL": "url_question_marks",
    "NoOfAmpersandInURL": "url_ampersands", "NoOfOtherSpecialCharsInURL": "url_special_chars",
    "SpacialCharRatioInURL": "url_special_ratio", "IsHTTPS": "url_is_https",
}

QUERIES, SQL = {}, {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def _one_feature(feature):
    def run(spark, sf_dir):
        pages = table(spark, sf_dir, "pages").select("page_id", "url")
        staged = pages.withColumn("Domain", U.domain("url")).withColumn("TLD", U.tld("Domain"))
        return staged.select("page_id", U.url_feature_columns("url")[feature].alias(feature))

    return run


for _feature, _name in NAMES.items():
    QUERIES[_name] = _one_feature(_feature)
    SQL[_name] = f"SELECT page_id, {SQL_EXPR[_feature]} AS {_feature} FROM ({STAGED_SQL})"

_ALL = ", ".join(f"{e} AS {f}" for f, e in SQL_EXPR.items())


@query("url_features_all", f"SELECT page_id, domain AS \"Domain\", tld AS \"TLD\", {_ALL} FROM ({STAGED_SQL})")
def url_features_all(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return U.url_features(pages, "url").drop("url")


@query("url_domain", f"SELECT page_id, domain AS \"Domain\" FROM ({STAGED_SQL})")
def url_domain(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.domain("url").alias("Domain"))


@query("url_tld", f"SELECT page_id, tld AS \"TLD\" FROM ({STAGED_SQL})")
def url_tld(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", U.domain("url").alias("d")).select("page_id", U.tld("d").alias("TLD"))


@query("url_obfuscation_rules", f"""
  SELECT page_id,
    CAST(length(url) - {_drop('[-_]')} > 3 AS INTEGER) AS many_dashes,
    CAST(regexp_matches(url, '[a-zA-Z]+[0-9]+|[0-9]+[a-zA-Z]+') AS INTEGER) AS mixed_alnum,
    CAST(length(url) % 4 = 0 AND regexp_matches(url, '^[A-Za-z0-9+/]*={{0,2}}\\z') AS INTEGER) AS base64_shape,
    CAST(regexp_matches(url, '^[a-zA-Z0-9.\\-]+$') AS INTEGER) AS bare_name,
    CAST(NOT regexp_matches(url, '[a-zA-Z]{{3,}}') AS INTEGER) AS no_letter_run
  FROM (SELECT page_id, CASE page_id % 6 WHEN 0 THEN url WHEN 1 THEN 'dGVz' || page_id || '=='
        WHEN 2 THEN 'site-' || page_id || '.example.com' WHEN 3 THEN 'http://12.34.5.' || page_id % 256
        WHEN 4 THEN regexp_replace(url, '/', '-_', 'g') ELSE url || '%41@' END AS url FROM pages)
""")
def url_obfuscation_rules(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    k, u = F.col("page_id"), F.col("url")
    varied = (
        F.when(k % 6 == 0, u)
        .when(k % 6 == 1, F.concat(F.lit("dGVz"), k.cast("string"), F.lit("==")))
        .when(k % 6 == 2, F.concat(F.lit("site-"), k.cast("string"), F.lit(".example.com")))
        .when(k % 6 == 3, F.concat(F.lit("http://12.34.5."), (k % 256).cast("string")))
        .when(k % 6 == 4, F.replace(u, F.lit("/"), F.lit("-_")))
        .otherwise(F.concat(u, F.lit("%41@")))
    )
    return pages.select("page_id", varied.alias("url")).select(
        "page_id", U.obfuscation_rules("url").alias("r")
    ).select("page_id", "r.*")


CHAR_FREQ_SQL = """
  SELECT c AS ch, count(*) AS n FROM (SELECT unnest(string_split(lower(url), '')) AS c FROM {src})
  WHERE regexp_matches(c, '^[\\p{{L}}\\p{{N}}]$') GROUP BY c
"""


@query("char_freq", f"""
  SELECT ch, n, round(n / CAST(sum(n) OVER () AS DOUBLE), 9) AS share
  FROM ({CHAR_FREQ_SQL.format(src='pages')})
""")
def char_freq(spark, sf_dir):
    counts = fit.char_counts(table(spark, sf_dir, "pages"), "url")
    total = sum(r["n"] for r in counts.collect())
    return counts.select("ch", "n", F.round(F.col("n") / F.lit(float(total)), 9).alias("share"))


@query("url_char_prob", f"""
  WITH f AS (SELECT ch, n / CAST(sum(n) OVER () AS DOUBLE) AS p FROM ({CHAR_FREQ_SQL.format(src='pages')})),
  c AS (SELECT page_id, length(url) AS len, unnest(string_split(lower(url), '')) AS ch FROM pages)
  SELECT page_id, round(sum(coalesce(p, 0)) / any_value(len), 9) AS "URLCharProb"
  FROM c LEFT JOIN f USING (ch) GROUP BY page_id
""")
def url_char_prob(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    probs = fit.char_shares(pages, "url")
    return pages.select("page_id", F.round(U.char_prob("url", probs), 9).alias("URLCharProb"))


# --- title scores ----------------------------------------------------------------

def fold_sql(title: str, base: str) -> str:
    """The word fold as a list_reduce over structs of one shape."""
    return f"""
      list_reduce(
        list_transform(string_split({title}, ' '), lambda w: {{'w': w, 'rest': '', 'score': 0e0}}),
        lambda acc, e: {{'w': '', 'rest': CASE WHEN contains(acc.rest, e.w) THEN
             CASE WHEN e.w = '' THEN acc.rest ELSE replace(acc.rest, e.w, '') END ELSE acc.rest END,
          'score': CASE WHEN NOT contains(acc.rest, e.w) THEN acc.score
             WHEN acc.score + share * length(e.w) > 99.9 THEN 100e0 ELSE acc.score + share * length(e.w) END}},
        {{'w': '', 'rest': {base}, 'score': 0e0}}
      ).score
    """


TITLE_SQL = """CASE WHEN regexp_matches(html, '(?is)<title>') THEN
  nullif(trim(replace(replace(replace(replace(regexp_extract(html, '(?is)<title>(.*?)</title>', 1),
  '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')), '') END"""


def title_score_sql(dom: str, url: str, title: str, src: str, cols: str) -> str:
    dom_text = (
        f"array_to_string(list_filter(list_slice(string_split({dom}, '.'), 1, len(string_split({dom}, '.')) - 1), "
        "lambda p: p <> 'www'), '.')"
    )
    net = f"string_split(regexp_extract({url}, '{AUTH}', 1), '.')"
    url_text = (
        f"array_to_string(list_filter(list_concat(list_slice({net}, 1, len({net}) - 1), list_filter(string_split("
        f"regexp_replace(regexp_extract({url}, '{PATH}', 1), ';[^/]*$', ''), '/'), lambda p: p <> '')), "
        "lambda p: p <> 'www'), '.')"
    )
    a = (
        f"SELECT *, {dom_text} AS dtext, {url_text} AS utext FROM ({src})"
    )
    one = (
        f"SELECT * EXCLUDE (share), {fold_sql(title, 'dtext')} AS dscore FROM "
        f"(SELECT *, CASE WHEN length(dtext) > 0 THEN 100e0 / length(dtext) ELSE 0e0 END AS share FROM ({a}))"
    )
    return (
        f"SELECT {cols}, CASE WHEN {title} IS NOT NULL AND {dom} IS NOT NULL THEN dscore END AS dscore, "
        f"CASE WHEN {title} IS NOT NULL AND {url} IS NOT NULL THEN {fold_sql(title, 'utext')} END AS uscore FROM "
        f"(SELECT *, CASE WHEN length(utext) > 0 THEN 100e0 / length(utext) ELSE 0e0 END AS share FROM ({one}))"
    )


# a title that shares words with the address of two pages in three
MADE_TITLE_SQL = (
    "CASE WHEN page_id % 3 = 0 THEN title ELSE replace(replace(domain, '.', ' '), 'example', "
    "CASE WHEN page_id % 3 = 1 THEN 'exam ple' ELSE 'other' END) || ' en ' END"
)


@query("title_match", f"""
  SELECT page_id, round(dscore, 6) AS "DomainTitleMatchScore", round(uscore, 6) AS "URLTitleMatchScore" FROM (
  {title_score_sql('domain', 'url', 'title', f'SELECT page_id, url, domain, {MADE_TITLE_SQL} AS title FROM '
   f'(SELECT *, {TITLE_SQL} AS title FROM ({STAGED_SQL}))', 'page_id')})
""")
def title_match(spark, sf_dir):
    pages = page_features.page_titles(spread(table(spark, sf_dir, "pages")))
    staged = pages.withColumn("Domain", U.domain("url"))
    words = F.replace(F.col("Domain"), F.lit("."), F.lit(" "))
    swap = F.when(F.col("page_id") % 3 == 1, "exam ple").otherwise("other")
    made = F.when(F.col("page_id") % 3 == 0, F.col("Title")).otherwise(
        F.concat(F.replace(words, F.lit("example"), swap), F.lit(" en "))
    )
    return staged.withColumn("Title", made).select(
        "page_id",
        F.round(U.domain_title_score("Title", "Domain"), 6).alias("DomainTitleMatchScore"),
        F.round(U.url_title_score("Title", "url"), 6).alias("URLTitleMatchScore"),
    )


@query("has_title", f"""
  SELECT page_id, CASE WHEN page_id % 4 = 1 THEN 0 WHEN title IS NOT NULL THEN 1 END AS "HasTitle"
  FROM (SELECT page_id, CASE WHEN page_id % 4 <> 2 THEN {TITLE_SQL} END AS title FROM pages)
""")
def has_title(spark, sf_dir):
    pages = page_features.page_titles(spread(table(spark, sf_dir, "pages")))
    given = F.when(F.col("page_id") % 4 == 1, 0)
    title = F.when(F.col("page_id") % 4 != 2, F.col("Title"))
    return pages.select("page_id", F.coalesce(given, F.when(title.isNotNull(), 1)).alias("HasTitle"))
