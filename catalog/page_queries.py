"""Page features over the enriched pages, site identity and element counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.fixtures import PAGES_RICH_SQL, pages_rich, table
from catalog.url_queries import AUTH, TITLE_SQL
from urlsift import constants as K
from urlsift import contract as C
from urlsift.functions import hosts as H
from urlsift.functions import text as X
from urlsift.operators import page_features as P
from urlsift.operators import sites as S
from urlsift.operators.elements import page_elements, page_tree, scan_pages

QUERIES, SQL = {}, {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def _i(sql):
    return f"CAST({sql} AS INTEGER)"


def _terms(terms):
    return "|".join(sorted(terms, key=lambda t: (-len(t), t)))


def _word(terms, text):
    return _i(f"regexp_matches({text}, '(?:^|[^\\p{{L}}\\p{{N}}_])(?:{_terms(terms)})(?:$|[^\\p{{L}}\\p{{N}}_])')")


# the site rule for hosts under the given pages and fragments, over a small rule list
def site_sql(host: str) -> str:
    rules = ", ".join(f"'{r}'" for r in K.SUFFIX_RULES if r[0] not in "*!")
    labels = f"string_split({host}, '.')"
    tails = (
        f"list_transform(range(1, len({labels}) + 1), lambda i: {{'i': i, 't': "
        f"array_to_string(list_slice({labels}, i, len({labels})), '.')}})"
    )
    start = f"list_extract(list_filter({tails}, lambda s: list_contains([{rules}], s.t)), 1).i"
    return (
        f"CASE WHEN {host} IS NULL THEN NULL WHEN {start} > 1 THEN "
        f"array_to_string(list_slice({labels}, {start} - 1, len({labels})), '.') ELSE {host} END"
    )


def host_sql(url: str) -> str:
    return f"nullif(lower(regexp_replace(regexp_replace(regexp_extract({url}, '{AUTH}', 1), '^.*@', ''), ':.*$', '')), '')"


def ref_site_sql(ref: str) -> str:
    """Site of a reference on a page with columns psite."""
    host = host_sql(ref)
    return (
        f"CASE WHEN regexp_matches({ref}, '^([a-zA-Z][a-zA-Z0-9+.\\-]*:)?//[^/?#]') THEN {site_sql(host)} "
        f"WHEN regexp_matches({ref}, '^(mailto|javascript|tel|data):') THEN NULL ELSE psite END"
    )


TAG = r"(?i)<{t}\b[^>]*>"


def tags(names: str) -> str:
    return f"regexp_extract_all(body, '(?i)<(?:{names})(?:\\s[^>]*)?>')"


def attr(tag: str, name: str) -> str:
    return f"coalesce(regexp_extract({tag}, '(?i)\\s{name}=\"([^\"]*)\"', 1), '')"


BASE_SQL = f"""
  SELECT *, {site_sql('phost')} AS psite FROM (
    SELECT *, {host_sql('url')} AS phost,
      regexp_replace(regexp_replace(html, '(?is)<!--.*?-->', '', 'g'), '(?is)(<script\\b[^>]*>).*?</script>', '\\1', 'g') AS body,
      array_to_string(list_transform(regexp_extract_all(html, '(?is)<script\\b[^>]*>.*?</script>'),
        lambda s: regexp_replace(regexp_replace(s, '(?is)^<script[^>]*>', ''), '(?is)</script>$', '')), chr(10)) AS scripts,
      {TITLE_SQL} AS title
    FROM ({PAGES_RICH_SQL}))
"""
TEXT_SQL = f"""
  SELECT *, lower(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(body,
      '(?is)<style\\b[^>]*>.*?</style>', ' ', 'g'), '<[^>]*>', ' ', 'g'),
      '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')) AS txt
  FROM ({BASE_SQL})
"""

ANCHOR_REFS_SQL = f"list_transform({tags('a')}, lambda t: {attr('t', 'href')})"
ALL_REFS_SQL = "list_concat(" * 6 + ANCHOR_REFS_SQL + "".join(
    f", list_transform({tags(t)}, lambda t: {attr('t', a)}))" for t, a in K.RESOURCE_REFS[1:]
)
_EMPTY = ", ".join(f"'{e}'" for e in K.EMPTY_REFS)


def ref_counts_sql(refs: str) -> str:
    live = f"list_filter({refs}, lambda r: NOT list_contains([{_EMPTY}], lower(trim(r))))"
    sites = f"list_transform({live}, lambda r: {ref_site_sql('r')})"
    return (
        f"{_i(f'len(list_filter({sites}, lambda s: s = psite))')} AS \"NoOfSelfRef\", "
        f"{_i(f'len(list_filter({refs}, lambda r: list_contains([{_EMPTY}], lower(trim(r)))))')} AS \"NoOfEmptyRef\", "
        f"{_i(f'len(list_filter({sites}, lambda s: s <> psite))')} AS \"NoOfExternalRef\""
    )


_REFRESH = f"list_filter({tags('meta')}, lambda t: lower({attr('t', 'http-equiv')}) = 'refresh')"
_POPUP_TEXT = (
    "scripts || chr(10) || array_to_string(regexp_extract_all(body, '(?i)\\son[a-z]+=\"([^\"]*)\"', 1), chr(10))"
)

PAGE_SQL = {
    "HasTitle": _i("title IS NOT NULL"),
    "LineOfCode": _i(
        "len(regexp_extract_all(html, chr(10))) + CASE WHEN html = '' OR right(html, 1) = chr(10) THEN 0 ELSE 1 END"
    ),
    "LargestLineLength": _i("list_max(list_transform(string_split(html, chr(10)), lambda l: length(l)))"),
    "HasFavicon": _i(
        f"len(list_filter({tags('link')}, lambda t: regexp_matches(lower({attr('t', 'rel')}), "
        f"'(^|\\s)(icon|shortcut|apple-touch-icon|mask-icon)(\\s|$)') AND trim({attr('t', 'href')}) <> '')) > 0"
    ),
    "Robots": _i(
        f"len(list_filter({tags('meta')}, lambda t: {attr('t', 'name')} = 'robots' AND "
        f"(contains(lower({attr('t', 'content')}), 'noindex') OR contains(lower({attr('t', 'content')}), 'none')))) = 0"
    ),
    "IsResponsive": _i(
        f"len(list_filter({tags('meta')}, lambda t: {attr('t', 'name')} = 'viewport' AND "
        f"contains(lower({attr('t', 'content')}), 'width='))) > 0 OR regexp_matches(html, '(?is)<style[^>]*>[^<]*@media')"
    ),
    "NoOfURLRedirect": _i(
        f"len(list_filter({_REFRESH}, lambda t: regexp_matches({attr('t', 'content')}, '(?i)url\\s*=')))"
    ),
    "NoOfSelfRedirect": _i(
        f"len(list_filter(list_transform({_REFRESH}, lambda t: trim(regexp_extract({attr('t', 'content')}, "
        f"'(?i)url\\s*=([^;]+)', 1))), lambda r: {ref_site_sql('r')} = psite))"
    ),
    "HasDescription": _i(
        f"len(list_filter({tags('meta')}, lambda t: ({attr('t', 'name')} = 'description' OR {attr('t', 'property')} "
        f"= 'og:description') AND trim({attr('t', 'content')}) <> '')) > 0"
    ),
    "NoOfPopup": _i(
        " + ".join(f"len(regexp_extract_all({_POPUP_TEXT}, '(?i){p}'))" for p in K.POPUP_PATTERNS)
    ),
    "NoOfiFrame": _i(f"len({tags('iframe|frame')})"),
    "HasExternalFormSubmit": _i(
        f"len(list_filter(list_filter(list_transform({tags('form')}, lambda t: trim({attr('t', 'action')})), "
        f"lambda r: r <> '' AND r <> '#'), lambda r: {ref_site_sql('r')} <> psite)) > 0"
    ),
    "HasSocialNet": _i(
        f"len(list_filter(list_transform(list_filter({ANCHOR_REFS_SQL}, lambda r: trim(r) <> ''), "
        f"lambda r: {ref_site_sql('r')}), lambda s: list_contains([{', '.join(repr(d) for d in K.SOCIAL_DOMAINS)}], s))) > 0"
    ),
    "HasSubmitButton": _i(
        f"len(list_filter({tags('input|button')}, lambda t: lower({attr('t', 'type')}) = 'submit')) > 0 OR "
        "regexp_matches(body, '(?is)<form\\b[^>]*>(?:[^<]|<[^/]|</[^f])*<button>')"
    ),
    "HasHiddenFields": _i(f"len(list_filter({tags('input')}, lambda t: lower({attr('t', 'type')}) = 'hidden')) > 0"),
    "HasPasswordField": _i(f"len(list_filter({tags('input')}, lambda t: lower({attr('t', 'type')}) = 'password')) > 0"),
    "Bank": _word(K.BANK_TERMS, "txt || ' ' || coalesce(lower(title), '') || ' ' || lower(url)"),
    "Pay": _word(K.PAY_TERMS, "txt || ' ' || coalesce(lower(title), '') || ' ' || lower(url)"),
    "Crypto": _word(K.CRYPTO_TERMS, "txt || ' ' || coalesce(lower(title), '') || ' ' || lower(url)"),
    "HasCopyrightInfo": _i(
        "regexp_matches(coalesce(regexp_extract(html, '(?is)<footer[^>]*>.*?</footer>'), ''), "
        "'(?i)©|&copy;|\\bcopyright\\b|all rights reserved') OR regexp_matches(right(html, 2000), "
        "'(?i)©|&copy;|\\bcopyright\\b|all rights reserved')"
    ),
    "NoOfImage": _i(f"len({tags('img')})"),
    "NoOfCSS": _i(
        f"len(list_filter({tags('link')}, lambda t: regexp_matches(lower({attr('t', 'rel')}), '(^|\\s)stylesheet(\\s|$)'))) "
        f"+ len({tags('style')})"
    ),
    "NoOfJS": _i(f"len({tags('script')})"),
}

GROUPS = {
    "page_title": ("HasTitle",),
    "page_lines": ("LineOfCode", "LargestLineLength"),
    "page_favicon": ("HasFavicon",),
    "page_robots": ("Robots",),
    "page_responsive": ("IsResponsive",),
    "page_redirects": ("NoOfURLRedirect", "NoOfSelfRedirect"),
    "page_description": ("HasDescription",),
    "page_popups": ("NoOfPopup",),
    "page_frames": ("NoOfiFrame",),
    "page_external_form": ("HasExternalFormSubmit",),
    "page_social": ("HasSocialNet",),
    "page_submit": ("HasSubmitButton",),
    "page_fields": ("HasHiddenFields", "HasPasswordField"),
    "page_keywords": ("Bank", "Pay", "Crypto"),
    "page_copyright": ("HasCopyrightInfo",),
    "page_resources": ("NoOfImage", "NoOfCSS", "NoOfJS"),
}


def _features(spark, sf_dir, **options):
    return P.page_features(pages_rich(spark, sf_dir), **options)


def _group(names):
    return lambda spark, sf_dir: _features(spark, sf_dir).select("page_id", *names)


for _name, _names in GROUPS.items():
    QUERIES[_name] = _group(_names)
    SQL[_name] = (
        f"SELECT page_id, {', '.join(f'{PAGE_SQL[n]} AS {n}' for n in _names)} FROM ({TEXT_SQL})"
    )

ALL_PAGE_SQL = (
    "SELECT page_id, url, title AS \"Title\", "
    + ", ".join(f"{e} AS \"{n}\"" for n, e in PAGE_SQL.items())
    + f", {ref_counts_sql(ANCHOR_REFS_SQL)} FROM ({TEXT_SQL})"
)
_COLS = ", ".join(f'"{c}"' for c in ("Title", "HasTitle", *C.PAGE_FEATURES))


@query("page_features_all", f"SELECT page_id, {_COLS} FROM ({ALL_PAGE_SQL})")
def page_features_all(spark, sf_dir):
    return _features(spark, sf_dir)


@query("refs_anchor", f"SELECT page_id, {ref_counts_sql(ANCHOR_REFS_SQL)} FROM ({BASE_SQL})")
def refs_anchor(spark, sf_dir):
    return _features(spark, sf_dir).select("page_id", "NoOfSelfRef", "NoOfEmptyRef", "NoOfExternalRef")


@query("refs_all", f"SELECT page_id, {ref_counts_sql(ALL_REFS_SQL)} FROM ({BASE_SQL})")
def refs_all(spark, sf_dir):
    return _features(spark, sf_dir, scope="all_resources").select(
        "page_id", "NoOfSelfRef", "NoOfEmptyRef", "NoOfExternalRef"
    )


@query("page_title_text", f"SELECT page_id, {TITLE_SQL} AS \"Title\" FROM pages")
def page_title_text(spark, sf_dir):
    return P.page_titles(table(spark, sf_dir, "pages").select("page_id", "html"))


@query("page_demoted", f"""
  SELECT page_id, CAST(NULL AS INTEGER) AS "NoOfPopup", CAST(NULL AS INTEGER) AS "Robots", {PAGE_SQL['NoOfImage']} AS "NoOfImage"
  FROM ({BASE_SQL})
""")
def page_demoted(spark, sf_dir):
    return _features(spark, sf_dir, demoted=("NoOfPopup", "Robots")).select(
        "page_id", "NoOfPopup", "Robots", "NoOfImage"
    )


@query("page_absent", f"""
  SELECT page_id, {', '.join(f'CASE WHEN page_id % 3 > 0 THEN "{n}" END AS "{n}"' for n in ('Title', 'HasTitle', 'NoOfJS', 'NoOfSelfRef', 'Robots'))}
  FROM ({ALL_PAGE_SQL})
""")
def page_absent(spark, sf_dir):
    pages = pages_rich(spark, sf_dir).withColumn("html", F.when(F.col("page_id") % 3 > 0, F.col("html")))
    return P.page_features(pages).select("page_id", "Title", "HasTitle", "NoOfJS", "NoOfSelfRef", "Robots")


@query("html_elements", f"""
  SELECT page_id, tag, count(*) AS n FROM (
    SELECT page_id, unnest(list_transform(regexp_extract_all(body, '<[a-zA-Z][a-zA-Z0-9]*'), lambda t: lower(substr(t, 2)))) AS tag
    FROM ({BASE_SQL})) GROUP BY page_id, tag
""")
def html_elements(spark, sf_dir):
    rows = page_elements(pages_rich(spark, sf_dir).select("page_id", "html"))
    return rows.groupBy("page_id", "tag").agg(F.count("*").alias("n"))


# --- trees --------------------------------------------------------------------------

_TAGS = "len(regexp_extract_all({}, '<{}[ >]'))"


@query("tree_paragraphs", f"""
  SELECT page_id, CAST({_TAGS.format('html', 'p')} AS BIGINT) AS paragraphs, CAST(0 AS BIGINT) AS nested,
    CAST({_TAGS.format('html', 'p')} AS BIGINT) AS in_article, CAST({_TAGS.format('html', 'li')} AS BIGINT) AS in_list FROM pages""")
def tree_paragraphs(spark, sf_dir):
    """A paragraph that is left open ends where the next begins, with the emphasis inside it; none is inside another."""
    tree = page_tree(table(spark, sf_dir, "pages"))
    up = tree.select("page_id", F.col("seq").alias("parent"), F.col("tag").alias("above"))
    both = tree.join(up, ["page_id", "parent"], "left")
    p = F.col("tag") == "p"
    return both.groupBy("page_id").agg(
        F.count_if(p).alias("paragraphs"), F.count_if(p & F.col("above").isin("p", "b")).alias("nested"),
        F.count_if(p & (F.col("above") == "article")).alias("in_article"),
        F.count_if((F.col("tag") == "li") & (F.col("above") == "ul")).alias("in_list"),
    )


#: Forms whose end tag stands inside another element, and fields before and behind them.
_FORM_HEAD = '<form action="/a"><div></form><input name="in1"></div><p><b></form><input name="out1">'
_FORM_TAIL = ('<table><form><tr><td><input name="in2"></form><td><input name="in3"></table><input name="out2"><form><p>text<form>'
              '<input name="in4"></form><input name="out3"></div></form><div><form><select><option>a<option>b</select></div><input name="out4">')


@query("tree_forms", f"""
  SELECT page_id, 'in1,in2,in3,in4' AS inside, 'out1,out2,out3,out4' AS outside,
    CAST(len(regexp_extract_all(html, '<[a-z]')) + 25 AS BIGINT) AS elements FROM pages""")
def tree_forms(spark, sf_dir):
    """Fields inside and outside forms that are closed in the wrong place, around each page."""
    pages = table(spark, sf_dir, "pages")
    whole = F.concat(F.lit(_FORM_HEAD), F.col("html"), F.lit(_FORM_TAIL))
    tree = page_tree(pages.select("page_id", whole.alias("html")))

    def names(where):
        return F.array_join(F.sort_array(F.collect_list(F.when(where & (F.col("tag") == "input"), F.col("name")))), ",")

    return tree.groupBy("page_id").agg(names(F.col("in_form")).alias("inside"), names(~F.col("in_form")).alias("outside"), F.count("*").alias("elements"))


@query("tree_footers", """
  SELECT page_id, 'left open ' || page_id || ' in a list one ' || trim(regexp_replace(regexp_replace(
    regexp_extract(replace(replace(html, '&copy;', '©'), '&middot;', '·'), '(?s)<footer>(.*?)</footer>', 1), '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS footer FROM pages""")
def tree_footers(spark, sf_dir):
    """Footers end with the element around them; an end tag that may not reach them leaves them open."""
    head = F.concat(F.lit("<div><footer>left open <b>"), F.col("page_id").cast("string"),
                    F.lit("</div>behind it<footer><ul><li>in a list</table><li>one</ul></footer><p>behind</footer>"))
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat(head, F.col("html")).alias("html"))
    found = scan_pages(pages).select("page_id", F.regexp_replace("footer", r"\s+", " ").alias("footer"))
    return found


# --- sites --------------------------------------------------------------------------

# hosts with many shapes, made from the page's own address
_HOST_VARIANTS = (
    "'{h}'", "'login.' || h || '.co.uk'", "h || '.test'", "'10.0.0.' || page_id % 256",
    "'user@' || h || ':8080'", "'co.uk'",
)
SITE_INPUT_SQL = """
  SELECT page_id, CASE page_id % 6 WHEN 0 THEN url WHEN 1 THEN 'https://login.' || h || '.co.uk/a'
    WHEN 2 THEN h || '.test' WHEN 3 THEN 'http://10.0.0.' || page_id % 256 || '/x'
    WHEN 4 THEN 'http://user@' || h || ':8080/' ELSE 'mailto:a@' || h END AS target
  FROM (SELECT page_id, url, regexp_extract(url, '//([^/?#]*)', 1) AS h FROM pages)
"""


def _site_inputs(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    h, k = F.regexp_extract("url", "//([^/?#]*)", 1), F.col("page_id")
    return pages.select(
        "page_id",
        F.when(k % 6 == 0, F.col("url"))
        .when(k % 6 == 1, F.concat(F.lit("https://login."), h, F.lit(".co.uk/a")))
        .when(k % 6 == 2, F.concat(h, F.lit(".test")))
        .when(k % 6 == 3, F.concat(F.lit("http://10.0.0."), (k % 256).cast("string"), F.lit("/x")))
        .when(k % 6 == 4, F.concat(F.lit("http://user@"), h, F.lit(":8080/")))
        .otherwise(F.concat(F.lit("mailto:a@"), h)).alias("target"),
    )


_TARGET_HOST = (
    "CASE WHEN regexp_matches(target, '^[a-z]+://') THEN " + host_sql("target")
    + " WHEN regexp_matches(target, '^[a-zA-Z][a-zA-Z0-9+.\\-]*:') THEN NULL ELSE lower(target) END"
)


@query("site_key", f"SELECT page_id, target, {site_sql('host')} AS site FROM (SELECT *, {_TARGET_HOST} AS host FROM ({SITE_INPUT_SQL}))")
def site_key(spark, sf_dir):
    rows = _site_inputs(spark, sf_dir)
    return rows.withColumn("site", H.site_of(F.col("target")))


@query("registrable_domain", f"""
  SELECT page_id, CASE WHEN host LIKE '10.0.0.%' THEN host WHEN host LIKE '%.test' THEN NULL ELSE {site_sql('host')} END AS registrable
  FROM (SELECT *, {_TARGET_HOST} AS host FROM ({SITE_INPUT_SQL}))
""")
def registrable_domain(spark, sf_dir):
    rows = _site_inputs(spark, sf_dir)
    target = F.col("target")
    host = F.when(target.rlike("^[a-z]+://"), H.host_of_url(target)).when(~target.contains(":"), target)
    return rows.select("page_id", H.registrable_domain(host).alias("registrable"))


@query("site_rule_table", """
  SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN 'b.s' || o_orderkey || '.example.com' WHEN 1 THEN NULL
      WHEN 2 THEN 'a.b.w' || o_orderkey || '.test' ELSE 'keep.x' || o_orderkey || '.test' END AS registrable,
    CASE o_orderkey % 4 WHEN 0 THEN 'b.s' || o_orderkey || '.example.com' WHEN 1 THEN 's' || o_orderkey || '.example.com'
      WHEN 2 THEN 'a.b.w' || o_orderkey || '.test' ELSE 'keep.x' || o_orderkey || '.test' END AS site FROM orders""")
def site_rule_table(spark, sf_dir):
    """Sites under more rules than orders, read as a table: the longest match decides, exceptions win."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    k, n = F.col("id").cast("string"), F.col("id") % 4
    rule = F.when(n < 2, F.concat(F.lit("s"), k, F.lit(".Example.com "))).when(n == 2, F.concat(F.lit("*.w"), k, F.lit(".test // wild")))
    lines = orders.select(F.explode(F.array(
        rule.otherwise(F.concat(F.lit("!keep.x"), k, F.lit(".test"))), F.when(n == 3, F.concat(F.lit("*.x"), k, F.lit(".test"))),
        F.lit("com"), F.lit("// a remark"), F.lit(""),
    )).alias("value"))
    host = (
        F.when(n == 0, F.concat(F.lit("A.b.s"), k, F.lit(".example.com"))).when(n == 1, F.concat(F.lit("s"), k, F.lit(".example.COM")))
        .when(n == 2, F.concat(F.lit("a.b.w"), k, F.lit(".test."))).otherwise(F.concat(F.lit("q.keep.x"), k, F.lit(".test")))
    )
    found = S.with_sites(orders.withColumn("host", host), S.rule_table(lines), "host")
    return found.select("id", "registrable", "site")


@query("ref_class", f"""
  SELECT page_id, cls, count(*) AS n FROM (
    SELECT page_id, CASE WHEN list_contains([{_EMPTY}], lower(trim(ref))) THEN 'empty'
      WHEN site IS NULL THEN 'none' WHEN site = psite THEN 'self' ELSE 'external' END AS cls
    FROM (SELECT page_id, psite, ref, {ref_site_sql('ref')} AS site FROM
      (SELECT page_id, psite, unnest({ALL_REFS_SQL}) AS ref FROM ({BASE_SQL}))))
  GROUP BY page_id, cls
""")
def ref_class(spark, sf_dir):
    pairs = F.array(*[F.lit(f"{t} {a}") for t, a in K.RESOURCE_REFS])
    pages = pages_rich(spark, sf_dir)
    page_site = H.site_of_host(H.host_of_url(F.col("url")))
    sites = pages.select("page_id", "url", page_site.alias("page_site"))
    rows = page_elements(pages.select("page_id", "html")).filter(
        F.exists(pairs, lambda p: F.split(p, " ")[0] == F.col("tag"))
    )
    attr_name = F.coalesce(
        *[F.when(F.col("tag") == t, F.lit(a)) for t, a in K.RESOURCE_REFS]
    )
    refs = rows.select("page_id", F.coalesce(F.element_at("attrs", attr_name), F.lit("")).alias("ref"))
    joined = refs.join(sites, "page_id")
    site = H.site_of_ref(F.col("ref"), F.col("url"), F.col("page_site"))
    empty = F.lower(X.strip(F.col("ref"))).isin(list(K.EMPTY_REFS))
    cls = (
        F.when(empty, "empty").when(site.isNull(), "none").when(site == F.col("page_site"), "self")
        .otherwise("external")
    )
    return joined.select("page_id", cls.alias("cls")).groupBy("page_id", "cls").agg(F.count("*").alias("n"))
