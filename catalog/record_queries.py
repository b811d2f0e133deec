"""Records, provenance, coverage, verdicts, agreement, admission and crawl logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.fit_queries import LINE_CTES, LINE_SPEC, line_stats, raw_pages, _remember
from catalog.fixtures import LINE_KEY, pages_rich, predictions, PREDICTIONS_SQL, raw_lineitem, table
from catalog.model_queries import _nb_ctes, line_matrix, line_model
from catalog.page_queries import ALL_PAGE_SQL, PAGE_SQL, TEXT_SQL, ANCHOR_REFS_SQL, ref_counts_sql
from urlsift import constants as K
from urlsift import contract as C
from urlsift.operators import admission as A
from urlsift.operators import agreement as G
from urlsift.operators import crawl as CR
from urlsift.operators import intervals as I
from urlsift.operators import profile as PF
from urlsift.operators import records as R
from urlsift.functions.addresses import address_reason
from urlsift.functions.stats import rounded
from urlsift.plans import scoring
from urlsift.runtime import written
from urlsift.streaming import rate_limit as RL

QUERIES, SQL = {}, {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


# --- crawl attempts derived from the pages -----------------------------------------------------

# Fixed values of the derived crawl log: attempts, statuses, types by page_id.
ATTEMPTS = ("dns_fail", "timeout", "blocked_by_policy", "disabled", "rate_limited", "connection_error")
STATUS = (200, 200, 404, 301, 200, 200, 503, 200, 302, 200, 200)
TYPES = ("text/html; charset=utf-8", "TEXT/HTML", "application/pdf", "", "text/plain", "application/xhtml+xml")


def crawl_log(spark, sf_dir):
    k = F.col("page_id")
    pages = pages_rich(spark, sf_dir)

    def pick(values, step):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (k * step % len(values) + 1).cast("int"))

    return pages.select(
        "page_id", "url",
        F.when(k % 17 == 5, pick(ATTEMPTS, 1)).alias("attempt"),
        pick(STATUS, 1).alias("status"),
        F.when(k % 4 != 0, F.concat("url", F.lit("next"))).alias("location"),
        (k % 6).cast("int").alias("hops"),
        pick(TYPES, 5).alias("content_type"),
        (F.length("html").cast("long") * F.when(k % 19 == 7, 100000).otherwise(1)).alias("bytes"),
        F.when(k % 23 == 3, F.concat(F.lit("<title>Just a Moment</title>"), "html")).otherwise(F.col("html")).alias("html"),
        F.when(k % 3 == 1, F.array(F.col("url"))).when(k % 3 == 2, F.array(F.lit("http://first.test/"), F.col("url")))
        .otherwise(F.array().cast("array<string>")).alias("redirects"),
    )


def _pick_sql(values, step):
    lits = ", ".join(repr(v) if not isinstance(v, int) else str(v) for v in values)
    return f"list_extract([{lits}], page_id * {step} % {len(values)} + 1)"


CRAWL_SQL = f"""
  SELECT page_id, url, CASE WHEN page_id % 17 = 5 THEN {_pick_sql(ATTEMPTS, 1)} END AS attempt,
    {_pick_sql(STATUS, 1)} AS status, CASE WHEN page_id % 4 <> 0 THEN url || 'next' END AS location,
    page_id % 6 AS hops, {_pick_sql(TYPES, 5)} AS content_type,
    length(html) * CASE WHEN page_id % 19 = 7 THEN 100000 ELSE 1 END AS bytes,
    CASE WHEN page_id % 23 = 3 THEN '<title>Just a Moment</title>' || html ELSE html END AS html
  FROM (SELECT p.page_id, p.url, r.html FROM pages p JOIN rich r USING (page_id))
"""
from catalog.fixtures import PAGES_RICH_SQL  # noqa: E402

CRAWL_CTE = f"WITH rich AS ({PAGES_RICH_SQL}), crawl AS ({CRAWL_SQL})"
_MARKERS = " OR ".join(f"contains(lower(left(html, 4096)), '{m}')" for m in K.CHALLENGE_MARKERS)
_KIND = "lower(trim(split_part(content_type, ';', 1)))"
OUTCOME_SQL = f"""CASE WHEN attempt = 'connection_error' THEN 'http_error' WHEN attempt IS NOT NULL THEN attempt
  WHEN status IN (301, 302, 303, 307, 308) AND coalesce(location, '') = '' THEN 'http_error'
  WHEN status IN (301, 302, 303, 307, 308) OR hops > 3 THEN 'blocked_by_policy'
  WHEN status >= 400 THEN 'http_error'
  WHEN {_KIND} <> '' AND {_KIND} NOT IN ('text/html', 'application/xhtml+xml', 'text/plain') THEN 'unsupported_type'
  WHEN bytes > 2097152 THEN 'too_large' WHEN {_MARKERS} THEN 'challenge_detected' ELSE 'ok' END"""


def with_outcome(spark, sf_dir):
    return crawl_log(spark, sf_dir).withColumn(
        "outcome",
        CR.crawl_outcome(
            attempt=F.col("attempt"), status=F.col("status"), location=F.col("location"), hops=F.col("hops"),
            content_type=F.col("content_type"), n_bytes=F.col("bytes"), html=F.col("html"),
        ),
    )


@query("crawl_outcome", f"{CRAWL_CTE} SELECT page_id, {OUTCOME_SQL} AS outcome FROM crawl")
def crawl_outcome(spark, sf_dir):
    return with_outcome(spark, sf_dir).select("page_id", "outcome")


@query("fetch_state", f"{CRAWL_CTE} SELECT page_id, CASE {OUTCOME_SQL} WHEN 'ok' THEN 'scraped' WHEN 'challenge_detected' "
       "THEN 'challenged' ELSE 'unreachable' END AS state FROM crawl")
def fetch_state(spark, sf_dir):
    return with_outcome(spark, sf_dir).select("page_id", CR.fetch_state(F.col("outcome")).alias("state"))


@query("challenge", f"{CRAWL_CTE} SELECT page_id, {_MARKERS} AS challenged FROM crawl")
def challenge(spark, sf_dir):
    return crawl_log(spark, sf_dir).select("page_id", CR.is_challenge(F.col("html")).alias("challenged"))


@query("outcome_counts", f"{CRAWL_CTE} SELECT {OUTCOME_SQL} AS outcome, count(*) AS n FROM crawl GROUP BY 1")
def outcome_counts(spark, sf_dir):
    return CR.outcome_counts(with_outcome(spark, sf_dir))


# --- records and provenance ----------------------------------------------------------------------

DEMOTED = ("NoOfPopup", "Robots", "HasFavicon")


def crawl_records(spark, sf_dir):
    """Records where two pages in three were read; demoted features never."""
    pages = pages_rich(spark, sf_dir)
    ready = pages.select(
        "page_id", "url", "html", F.when(F.col("page_id") % 3 > 0, "ok").otherwise("timeout").alias("outcome")
    )
    return R.build_records(ready, final_url=None, redirects=None, demoted=DEMOTED)


def _record_sql():
    cols = []
    for c in C.WORKING:
        if c == "URL":
            cols.append('url AS "URL"')
        elif c == "Title":
            cols.append('CASE WHEN page_id % 3 > 0 THEN "Title" END AS "Title"')
        elif c in DEMOTED or (c not in C.PAGE_FEATURES and c not in C.TEXT):
            cols.append(f'CAST(NULL AS DOUBLE) AS "{c}"')
        elif c in C.TEXT:
            cols.append(f'CAST(NULL AS VARCHAR) AS "{c}"')
        else:
            cols.append(f'CASE WHEN page_id % 3 > 0 THEN CAST("{c}" AS DOUBLE) END AS "{c}"')
    return f"SELECT page_id, {', '.join(cols)} FROM ({ALL_PAGE_SQL})"


RECORD_SQL = _record_sql()


@query("records", RECORD_SQL)
def records(spark, sf_dir):
    return crawl_records(spark, sf_dir)


def _source_sql(c, first=False):
    if c in DEMOTED:
        return "'demoted'"
    if c in C.URL_FEATURES:
        return "'url'" if first else f"CASE WHEN \"URL\" IS NOT NULL OR \"{c}\" IS NOT NULL THEN 'url' ELSE 'imputed' END"
    if c in C.TITLE_FEATURES:
        return "CASE WHEN \"Title\" IS NOT NULL THEN 'scraped' ELSE 'imputed' END"
    return f"CASE WHEN \"{c}\" IS NOT NULL THEN 'scraped' ELSE 'imputed' END"


def _long_sql(src, key, first=False):
    rows = ", ".join(f"{{'feature': '{c}', 'source': {_source_sql(c, first)}}}" for c in C.FEATURES)
    return f"SELECT {key}, s.feature AS feature, s.source AS source FROM (SELECT {key}, unnest([{rows}]) AS s FROM ({src}))"


# raw page records have rows without a URL, which the crawl records never have
from catalog.fit_queries import RAW_PAGES_SQL  # noqa: E402

PROVENANCE_SQL = _long_sql(RAW_PAGES_SQL, "id")


@query("provenance_initial", _long_sql(RECORD_SQL, "page_id", first=True))
def provenance_initial(spark, sf_dir):
    found = R.initial_provenance(crawl_records(spark, sf_dir), "page_id", DEMOTED)
    return found.select("page_id", F.explode("provenance").alias("feature", "source"))


@query("provenance_final", PROVENANCE_SQL)
def provenance_final(spark, sf_dir):
    return R.provenance_long(raw_pages(spark, sf_dir), "id", DEMOTED)


@query("provenance_counts", f"SELECT source, count(*) AS n FROM ({PROVENANCE_SQL}) GROUP BY source")
def provenance_counts(spark, sf_dir):
    return provenance_final(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n"))


_PAGE_LIST = ", ".join(f"'{c}'" for c in C.PAGE_FEATURES)
COVERAGE_SQL = f"""SELECT id, scraped, obtainable, CASE WHEN obtainable > 0 THEN scraped / CAST(obtainable AS DOUBLE) ELSE 0e0 END AS coverage
  FROM (SELECT id, CAST(count(*) FILTER (WHERE source = 'scraped') AS INTEGER) AS scraped,
    CAST(count(*) FILTER (WHERE source <> 'demoted') AS INTEGER) AS obtainable
  FROM ({PROVENANCE_SQL}) WHERE feature IN ({_PAGE_LIST}) GROUP BY id)"""


def _covered(spark, sf_dir):
    return R.coverage(R.provenance(raw_pages(spark, sf_dir), "id", DEMOTED))


@query("coverage", COVERAGE_SQL)
def coverage(spark, sf_dir):
    return _covered(spark, sf_dir).drop("provenance")


@query("abstention", f"SELECT id, coverage < 0.68 AS abstained, CASE WHEN coverage < 0.68 THEN scraped || ' of ' || obtainable || "
       f"' page features read, below the 68% threshold' ELSE '' END AS abstain_reason FROM ({COVERAGE_SQL})")
def abstention(spark, sf_dir):
    return R.abstain(_covered(spark, sf_dir), 0.68).select("id", "abstained", "abstain_reason")


FAMILIES = {"knn": ("knn_vote_pred", "knn_library_pred"), "naive_bayes": ("nb_floor_pred", "nb_smooth_pred")}
_CONSENSUS = (
    "CASE WHEN mix % 7 = 0 THEN NULL WHEN knn_vote_pred = knn_library_pred AND nb_floor_pred = nb_smooth_pred AND "
    "knn_vote_pred = nb_floor_pred THEN CASE knn_vote_pred WHEN 0 THEN 'phishing' ELSE 'legitimate' END END"
)
VERDICT_SQL = (
    f"SELECT {', '.join(LINE_KEY)}, {_CONSENSUS} AS consensus, CASE WHEN mix % 7 = 0 THEN 'insufficient evidence' "
    f"ELSE coalesce({_CONSENSUS}, 'split') END AS verdict FROM ({PREDICTIONS_SQL})"
)


@query("verdict", VERDICT_SQL)
def verdict(spark, sf_dir):
    rows = predictions(spark, sf_dir)
    return rows.withColumns(R.verdict_columns(FAMILIES, F.col("mix") % 7 == 0)).select(*LINE_KEY, "consensus", "verdict")


@query("abstained_count", f"SELECT count(*) AS abstained FROM ({VERDICT_SQL}) WHERE verdict = 'insufficient evidence'")
def abstained_count(spark, sf_dir):
    return verdict(spark, sf_dir).filter("verdict = 'insufficient evidence'").agg(F.count("*").alias("abstained"))


@query("batch_summary", " UNION ALL ".join(
    f"SELECT '{m}' AS model, count(*) FILTER (WHERE {m}_pred = 0) AS flagged, round(avg(CASE WHEN {m}_pred = 0 THEN 1e0 ELSE 0e0 END), 9) AS share "
    f"FROM ({PREDICTIONS_SQL})" for m in ("knn_vote", "nb_floor")))
def batch_summary(spark, sf_dir):
    rows = predictions(spark, sf_dir).withColumnsRenamed({f"{m}_pred": f"{m}_label" for m in ("knn_vote", "nb_floor")})
    return scoring.batch_summary(rows, {"knn_vote": 0, "nb_floor": 0}).withColumn("share", F.round("share", 9))


def line_reference(spark, sf_dir):
    return _remember(
        "line-reference", spark, sf_dir,
        lambda: PF.reference_stats(line_matrix(spark, sf_dir).filter("split = 'train'"), LINE_SPEC.features),
    )


def _inspector_sql():
    parts = []
    for i, c in enumerate(LINE_SPEC.features):
        v = f"CAST(CAST(\"{c}\" AS FLOAT) AS DOUBLE)"

        def dens(k):
            return (f"(-0.5e0 * (ln(2 * pi()) + 2 * ln((SELECT s{i} FROM nb WHERE k = {k}))) - 0.5e0 * pow(({v} - (SELECT m{i} FROM nb WHERE k = {k})) "
                    f"/ (SELECT s{i} FROM nb WHERE k = {k}), 2))")

        def z(k):
            std = f"(SELECT stddev_pop(\"{c}\") FROM scaled WHERE split = 'train' AND label = {k})"
            return (f"round(({v} - (SELECT avg(\"{c}\") FROM scaled WHERE split = 'train' AND label = {k})) / "
                    f"(CASE WHEN {std} = 0 THEN 1 ELSE {std} END), 4)")

        parts.append(
            f"SELECT {', '.join(LINE_KEY)}, '{c}' AS feature, round({v}, 4) + 0.0 AS value, round((SELECT median(\"{c}\") FROM scaled WHERE split = 'train'), 4) + 0.0 AS median, "
            f"{z(0)} + 0.0 AS z_phishing, {z(1)} + 0.0 AS z_legitimate, round({dens(0)} - {dens(1)}, 4) + 0.0 AS contribution FROM scaled"
        )
    return _nb_ctes(False) + " " + " UNION ALL ".join(parts)


@query("inspector", _inspector_sql())
def inspector(spark, sf_dir):
    out = R.feature_inspector(line_matrix(spark, sf_dir), line_reference(spark, sf_dir), line_model(spark, sf_dir), LINE_KEY)
    return rounded(out, ("value", "median", "z_phishing", "z_legitimate", "contribution"), 4)


@query("reference_stats", LINE_CTES + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, " + ", ".join(f"round({e}, 5) AS {n}" for n, e in {
        "min": f'CAST(min("{c}") AS DOUBLE)', "p1": f'quantile_cont("{c}", 0.01)', "p25": f'quantile_cont("{c}", 0.25)', "median": f'quantile_cont("{c}", 0.5)',
        "p75": f'quantile_cont("{c}", 0.75)', "p99": f'quantile_cont("{c}", 0.99)', "max": f'CAST(max("{c}") AS DOUBLE)',
        "mean_phishing": f'avg("{c}") FILTER (WHERE label = 0)', "std_phishing": f'stddev_pop("{c}") FILTER (WHERE label = 0)',
        "mean_legitimate": f'avg("{c}") FILTER (WHERE label = 1)', "std_legitimate": f'stddev_pop("{c}") FILTER (WHERE label = 1)',
    }.items()) + " FROM scaled WHERE split = 'train'" for c in LINE_SPEC.features))
def reference_stats(spark, sf_dir):
    ref = line_reference(spark, sf_dir)
    return ref.select("feature", *[F.round(c, 5).alias(c) for c in ref.columns if c != "feature"])


# --- agreement gate ------------------------------------------------------------------------------

G_BINARY = ("HasSubmitButton", "Bank", "Robots", "HasSocialNet")
G_COUNTS = ("LineOfCode", "LargestLineLength", "NoOfImage", "NoOfSelfRef", "NoOfPopup")


def paired_pages(spark, sf_dir):
    def make():
        page = raw_pages_features(spark, sf_dir)
        k = F.col("page_id")
        changed = page.select(
            "sha1",
            *[F.when(k % 7 == 0, 1 - F.col(c)).otherwise(F.col(c)).alias(c) for c in G_BINARY],
            *[F.when(k % 11 == 3, None).otherwise(F.col(c) + F.when(k % 7 == 0, k % 5).otherwise(0)).alias(c) for c in G_COUNTS],
        )
        expected = page.withColumn("label", F.when(k % 6 == 0, 0).otherwise(1))
        return written(G.pair_up(expected, changed, ["sha1"], [*G_BINARY, *G_COUNTS], ["page_id", "label"]), "paired")

    return _remember("paired", spark, sf_dir, make)


def raw_pages_features(spark, sf_dir):
    from urlsift.operators.page_features import page_features

    def make():
        pages = pages_rich(spark, sf_dir)
        hashed = pages.withColumn("sha1", F.sha1(F.encode("html", "UTF-8")))
        return written(page_features(hashed, keys=("page_id", "sha1")), "page-features")

    return _remember("page-features", spark, sf_dir, make)


def _paired_sql():
    cols = [f'"{c}"::DOUBLE AS e_{c}, (CASE WHEN page_id % 7 = 0 THEN 1 - "{c}" ELSE "{c}" END)::DOUBLE AS a_{c}' for c in G_BINARY]
    cols += [f'"{c}"::DOUBLE AS e_{c}, (CASE WHEN page_id % 11 = 3 THEN NULL ELSE "{c}" + CASE WHEN page_id % 7 = 0 THEN page_id % 5 ELSE 0 END END)::DOUBLE AS a_{c}' for c in G_COUNTS]
    return f"SELECT page_id, CASE WHEN page_id % 6 = 0 THEN 0 ELSE 1 END AS label, {', '.join(cols)} FROM ({ALL_PAGE_SQL})"


LONG_PAIRS_SQL = " UNION ALL ".join(
    f"SELECT page_id, label, '{c}' AS feature, '{'binary' if c in G_BINARY else 'count'}' AS kind, e_{c} AS e, a_{c} AS a FROM p"
    for c in (*G_BINARY, *G_COUNTS)
)
GATE_CTES = f"""
  p AS MATERIALIZED ({_paired_sql()}), long AS MATERIALIZED (SELECT * FROM ({LONG_PAIRS_SQL}) WHERE e IS NOT NULL AND a IS NOT NULL),
  rk AS (SELECT *, rank() OVER (PARTITION BY feature, label ORDER BY e) + (count(*) OVER (PARTITION BY feature, label, e) - 1) / 2e0 AS re,
    rank() OVER (PARTITION BY feature, label ORDER BY a) + (count(*) OVER (PARTITION BY feature, label, a) - 1) / 2e0 AS ra FROM long),
  base AS (SELECT feature, kind, label, count(*) AS n, avg(CASE WHEN e = a THEN 1e0 ELSE 0e0 END) AS rate,
    CASE WHEN min(e) < max(e) AND min(a) < max(a) THEN corr(re, ra) END AS rho, median(abs(a - e)) AS mae,
    median(CASE WHEN e <> 0 THEN a / e END) AS mratio FROM rk GROUP BY feature, kind, label),
  pe AS (SELECT feature, label, sum(x.c * y.c) / CAST(any_value(n) * any_value(n) AS DOUBLE) AS pe FROM
    (SELECT feature, label, e AS v, count(*) AS c FROM long GROUP BY ALL) x JOIN (SELECT feature, label, a AS v, count(*) AS c FROM long GROUP BY ALL) y
    USING (feature, label, v) JOIN base USING (feature, label) GROUP BY feature, label),
  judged AS (SELECT feature, kind, label, n, CASE WHEN n < 5 THEN 'insufficient_data' WHEN kind = 'binary' THEN 'agreement_rate' ELSE 'spearman_rho' END AS metric,
    CASE WHEN n >= 5 THEN round(CASE WHEN kind = 'binary' THEN rate ELSE rho END, 4) END AS value,
    CASE WHEN n >= 5 THEN CASE WHEN kind = 'binary' THEN 0.85::DOUBLE ELSE 0.7::DOUBLE END END AS gate,
    n >= 5 AND coalesce(CASE WHEN kind = 'binary' THEN rate >= 0.85 ELSE rho >= 0.7 END, false) AS passed,
    CASE WHEN n >= 5 AND kind = 'binary' AND coalesce(pe, 0) < 1 THEN round((rate - coalesce(pe, 0)) / (1 - coalesce(pe, 0)), 4) END AS cohens_kappa,
    CASE WHEN n >= 5 AND kind = 'count' THEN round(mae, 4) END AS median_abs_error,
    CASE WHEN n >= 5 AND kind = 'count' THEN round(mratio, 4) END AS median_ratio
    FROM base LEFT JOIN pe USING (feature, label))
"""
_GATE_COLS = "feature, kind, metric, value, gate, passed, n, cohens_kappa, median_abs_error, median_ratio"


def legit_report(spark, sf_dir):
    def make():
        rows = paired_pages(spark, sf_dir).filter("label = 1")
        return written(G.score_features(rows, G_BINARY, G_COUNTS), "report")

    return _remember("report", spark, sf_dir, make)


@query("agreement", f"WITH {GATE_CTES} SELECT {_GATE_COLS} FROM judged WHERE label = 1")
def agreement(spark, sf_dir):
    return legit_report(spark, sf_dir)


@query("agreement_split", f"WITH {GATE_CTES} SELECT j.feature, j.value, j.passed, j.n, q.metric AS phishing_metric, q.value AS phishing_value, "
       "q.passed AS phishing_passed, q.n AS phishing_n FROM judged j LEFT JOIN judged q ON j.feature = q.feature AND q.label = 0 WHERE j.label = 1")
def agreement_split(spark, sf_dir):
    full = G.split_report(paired_pages(spark, sf_dir), G_BINARY, G_COUNTS)
    return full.select("feature", "value", "passed", "n", "phishing_metric", "phishing_value", "phishing_passed", "phishing_n")


@query("demotions", f"WITH {GATE_CTES} SELECT feature FROM judged WHERE label = 1 AND NOT passed")
def demotions(spark, sf_dir):
    return G.demotions(legit_report(spark, sf_dir))


@query("kappa", f"WITH {GATE_CTES} SELECT feature, round(CASE WHEN coalesce(pe, 0) < 1 THEN (rate - coalesce(pe, 0)) / (1 - coalesce(pe, 0)) END, 6) AS kappa "
       "FROM base LEFT JOIN pe USING (feature, label) WHERE label = 1")
def kappa(spark, sf_dir):
    pairs = G.value_pairs(paired_pages(spark, sf_dir).filter("label = 1"), [*G_BINARY, *G_COUNTS])
    return G.cohens_kappa(pairs).withColumn("kappa", F.round("kappa", 6))


LINE_PAIR = "abs(l_partkey * 7 + l_linenumber) % 50"


@query("spearman_lineitem", """
  WITH r AS (SELECT l_quantity AS e, l_extendedprice AS a FROM lineitem), k AS (SELECT
    rank() OVER (ORDER BY e) + (count(*) OVER (PARTITION BY e) - 1) / 2e0 AS re, rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2e0 AS ra FROM r)
  SELECT 'x' AS feature, round(corr(re, ra), 6) AS rho FROM k""")
def spearman_lineitem(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").alias("x_expected"), F.col("l_extendedprice").alias("x_actual")
    )
    found = G.spearman(G.value_pairs(rows, ["x"]), rows_per_range=20_000)
    return found.withColumn("rho", F.round("rho", 6))


_SCOPE_SQL = f"""
  WITH a AS (SELECT page_id, {ref_counts_sql(ANCHOR_REFS_SQL)} FROM ({TEXT_SQL})),
  vals AS (SELECT 'anchor' AS scope, 'NoOfSelfRef' AS feature, avg("NoOfSelfRef") / 20 AS value FROM a
    UNION ALL SELECT 'anchor', 'NoOfExternalRef', avg("NoOfExternalRef") FROM a
    UNION ALL SELECT 'all_resources', 'NoOfSelfRef', NULL
    UNION ALL SELECT 'all_resources', 'NoOfExternalRef', avg("NoOfExternalRef") FROM a),
  m AS (SELECT scope, avg(coalesce(value, 0)) AS mv FROM vals GROUP BY scope)
  SELECT scope, round(mv, 6) AS mean_value, scope = (SELECT scope FROM m ORDER BY mv DESC, CASE scope WHEN 'anchor' THEN 0 ELSE 1 END LIMIT 1) AS chosen FROM m
"""


@query("scope_choice", _SCOPE_SQL)
def scope_choice(spark, sf_dir):
    page = raw_pages_features(spark, sf_dir)
    one = page.agg(F.avg("NoOfSelfRef").alias("s"), F.avg("NoOfExternalRef").alias("x"))
    rows = F.array(
        F.struct(F.lit("anchor").alias("scope"), F.lit("NoOfSelfRef").alias("feature"), (F.col("s") / 20).alias("value")),
        F.struct(F.lit("anchor").alias("scope"), F.lit("NoOfExternalRef").alias("feature"), F.col("x").alias("value")),
        F.struct(F.lit("all_resources").alias("scope"), F.lit("NoOfSelfRef").alias("feature"), F.lit(None).cast("double").alias("value")),
        F.struct(F.lit("all_resources").alias("scope"), F.lit("NoOfExternalRef").alias("feature"), F.col("x").alias("value")),
    )
    reports = one.select(F.explode(rows).alias("r")).select("r.*")
    return G.choose_scope(reports).withColumn("mean_value", F.round("mean_value", 6))


# --- admission ----------------------------------------------------------------------------------

DENY = ("spam-farm.example.org", "example.net")


def _odd_urls(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    k, u = F.col("page_id"), F.col("url")
    h = F.regexp_extract("url", "//([^/?#]*)", 1)
    odd = (
        F.when(k % 14 == 0, F.lit("   "))
        .when(k % 14 == 1, F.concat(u, F.repeat(F.lit("x"), 2100)))
        .when(k % 14 == 2, F.concat(F.lit("ftp://"), h, F.lit("/x")))
        .when(k % 14 == 3, F.concat(F.lit("http://user:pw@"), h, F.lit("/")))
        .when(k % 14 == 4, F.lit("http://"))
        .when(k % 14 == 5, F.concat(F.lit("http://"), h, F.lit(":99999/")))
        .when(k % 14 == 6, F.concat(F.lit("http://"), h, F.lit(":8080/")))
        .when(k % 14 == 7, F.concat(F.lit("https://"), h, F.lit(":443/a?b=c")))
        .when(k % 14 == 8, F.concat(F.lit("javascript:alert("), k.cast("string"), F.lit(")")))
        .when(k % 14 == 9, F.concat(F.lit("http://"), h, F.lit(":8x/")))
        .otherwise(F.concat(F.lit("  "), u, F.lit(" ")))
    )
    return pages.select("page_id", odd.alias("url"))


_ODD_SQL = """SELECT page_id, CASE page_id % 14 WHEN 0 THEN '   ' WHEN 1 THEN url || repeat('x', 2100) WHEN 2 THEN 'ftp://' || h || '/x'
  WHEN 3 THEN 'http://user:pw@' || h || '/' WHEN 4 THEN 'http://' WHEN 5 THEN 'http://' || h || ':99999/' WHEN 6 THEN 'http://' || h || ':8080/'
  WHEN 7 THEN 'https://' || h || ':443/a?b=c' WHEN 8 THEN 'javascript:alert(' || page_id || ')' WHEN 9 THEN 'http://' || h || ':8x/'
  ELSE '  ' || url || ' ' END AS url FROM (SELECT *, regexp_extract(url, '//([^/?#]*)', 1) AS h FROM pages)"""
_DENY_SQL = " OR ".join(f"host = '{d}' OR ends_with(host, '.{d}')" for d in DENY)
ADMISSION_SQL = f"""
  SELECT page_id, CASE WHEN u = '' THEN 'empty_url' WHEN length(u) > 2048 THEN 'url_too_long' WHEN NOT scheme IN ('http', 'https') THEN 'scheme_not_allowed'
    WHEN contains(auth, '@') THEN 'credentials_in_url' WHEN host = '' THEN 'missing_host'
    WHEN port <> '' AND (NOT regexp_matches(port, '^[0-9]+$') OR TRY_CAST(port AS INTEGER) > 65535) THEN 'invalid_port'
    WHEN CASE WHEN port <> '' THEN TRY_CAST(port AS INTEGER) WHEN scheme = 'https' THEN 443 ELSE 80 END NOT IN (80, 443) THEN 'port_not_allowed'
    WHEN {_DENY_SQL} THEN 'host_denied' END AS reason
  FROM (SELECT *, lower(split_part(hostport, ':', 1)) AS host, split_part(hostport, ':', 2) AS port FROM (
    SELECT *, regexp_replace(auth, '^.*@', '') AS hostport FROM (SELECT page_id, trim(url) AS u, lower(regexp_extract(trim(url), '^([a-zA-Z][a-zA-Z0-9+.-]*):', 1)) AS scheme,
    regexp_extract(trim(url), '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1) AS auth FROM ({_ODD_SQL}))))
"""


@query("url_admission", ADMISSION_SQL)
def url_admission(spark, sf_dir):
    return _odd_urls(spark, sf_dir).select("page_id", A.admission_reason(F.col("url"), DENY).alias("reason"))


_DENY_TABLE_SQL = "SELECT DISTINCT regexp_extract(url, '//(?:www\\.|m\\.|blog\\.)?([^/?#]*)', 1) AS host FROM pages WHERE page_id % 9 = 0"


@query("deny_table", f"""
  SELECT page_id FROM (SELECT page_id, lower(regexp_extract(url, '//([^/?#]*)', 1)) AS host FROM pages) p
  WHERE EXISTS (SELECT 1 FROM ({_DENY_TABLE_SQL}) d WHERE p.host = d.host OR ends_with(p.host, '.' || d.host))
""")
def deny_table(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    deny = pages.filter("page_id % 9 = 0").select(
        F.regexp_extract("url", r"//(?:www\.|m\.|blog\.)?([^/?#]*)", 1).alias("host")
    )
    rows = pages.select("page_id", F.regexp_extract("url", "//([^/?#]*)", 1).alias("host"))
    return A.denied_rows(rows, deny, "page_id")


# addresses of every class, made from the page key
_A, _B = "page_id * 7 % 256", "page_id * 11 % 256"
ADDRESS_FORMS = (
    "'10.' || {a} || '.' || {b} || '.1'", "'192.0.' || page_id % 4 || '.' || {b}", "{a} || '.' || {b} || '.' || page_id % 256 || '.9'",
    "'100.' || {a} || '.0.1'", "'2001:db8::' || page_id % 10000", "'::ffff:' || {a} || '.' || {b} || '.0.' || page_id % 256",
    "'fe80::' || page_id % 1000", "'2606:4700::' || page_id % 1000", "'0.0.0.0'", "'ff02::' || page_id % 100", "'host' || page_id || '.test'", "'::1'",
)
ADDRESS_FORMS = tuple(f.format(a=f"({_A})", b=f"({_B})") for f in ADDRESS_FORMS)
_ADDRESS_CASE = "CASE page_id % 12 " + " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(ADDRESS_FORMS)) + " END"


def _v4_sql(n):
    def rng(block):
        import ipaddress
        net = ipaddress.ip_network(block)
        return f"{n} BETWEEN {int(net.network_address)} AND {int(net.broadcast_address)}"

    whens = []
    for reason, nets in K.IPV4_BLOCKS:
        cond = "(" + " OR ".join(rng(x) for x in nets) + ")"
        if reason == "private_address":
            cond += " AND NOT (" + " OR ".join(rng(x) for x in K.IPV4_PUBLIC) + ")"
        whens.append(f"WHEN {cond} THEN '{reason}'")
    return f"CASE {' '.join(whens)} END"


_QUAD = "regexp_extract(ip, '(\\d+\\.\\d+\\.\\d+\\.\\d+)$', 1)"
_NUM = (
    f"CASE WHEN {_QUAD} <> '' THEN CAST(split_part({_QUAD}, '.', 1) AS BIGINT) * 16777216 + CAST(split_part({_QUAD}, '.', 2) AS BIGINT) * 65536 "
    f"+ CAST(split_part({_QUAD}, '.', 3) AS BIGINT) * 256 + CAST(split_part({_QUAD}, '.', 4) AS BIGINT) END"
)


@query("address_class", f"""
  SELECT page_id, ip, CASE WHEN ip LIKE 'host%' THEN NULL WHEN ip LIKE '::ffff:%' THEN coalesce({_v4_sql('num')}, 'ipv4_mapped')
    WHEN num IS NOT NULL THEN {_v4_sql('num')} WHEN ip = '::1' THEN 'loopback_address' WHEN ip LIKE '2001:db8::%' OR ip LIKE 'fe80::%' THEN 'private_address'
    WHEN ip LIKE 'ff02::%' THEN 'multicast_address' END AS reason
  FROM (SELECT *, {_NUM} AS num FROM (SELECT page_id, {_ADDRESS_CASE} AS ip FROM pages))
""")
def address_class(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", F.expr(_ADDRESS_CASE).alias("ip"))
    return rows.withColumn("reason", address_reason(F.col("ip")))


@query("address_class_table", SQL["address_class"])
def address_class_table(spark, sf_dir):
    """The same classes from the table of blocks."""
    rows = table(spark, sf_dir, "pages").select("page_id", F.expr(_ADDRESS_CASE).alias("ip"))
    return I.with_reason(rows, I.block_table(I.fixed_blocks(spark)), "ip")


@query("address_block_list", """
  SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 0 THEN 'listed_network' WHEN o_orderkey % 3 = 0 THEN 'listed_address' END AS reason FROM orders""")
def address_block_list(spark, sf_dir):
    """A list of blocks, one for each order, and an address for each order: every third is in the list, as an address or in a network,
    some of which have an exempt part."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    b = [(F.floor(F.col("id") / d) % 256).cast("int").cast("string") for d in (65536, 256, 1)]
    base = F.concat(F.lit("11."), F.concat_ws(".", *b))
    wide = F.concat(F.lit("2a00:"), F.lower(F.hex(F.floor(F.col("id") / 65536))), F.lit(":"), F.lower(F.hex(F.col("id") % 65536)))
    even, listed = F.col("id") % 2 == 0, F.col("id") % 3 == 0
    block = F.when(even & listed, F.concat(wide, F.lit("::/48"))).when(listed, base).when(even, F.concat(wide, F.lit("::/64"))).otherwise(F.lit("no block"))
    reason = F.when(even, "listed_network").otherwise("listed_address")
    rows = orders.select(block.alias("block"), reason.alias("reason"), F.lit(1).alias("rank"), (even & ~listed).alias("exempt"))
    networks = orders.filter(even & ~listed).select(F.concat(wide, F.lit("::/56")).alias("block"), F.lit("listed_network").alias("reason"), F.lit(1).alias("rank"), F.lit(False).alias("exempt"))
    asked = orders.withColumn("address", F.when(even, F.concat(wide, F.lit("::7"))).otherwise(base))
    return I.with_reason(asked, I.block_table(rows.union(networks)), "address").select("id", "reason")


@query("deny_forms", "SELECT page_id FROM pages WHERE page_id % 4 < 2")
def deny_forms(spark, sf_dir):
    """Entries and hosts in other scripts, in upper case, or with a dot at the end meet in the form resolvers see."""
    pages = table(spark, sf_dir, "pages")
    k, n = F.col("page_id").cast("string"), F.col("page_id") % 4
    deny = pages.select(F.when(n == 0, F.concat(F.lit("Bücher"), k, F.lit(".test"))).otherwise(F.concat(F.lit("evil"), k, F.lit(".test."))).alias("host"))
    host = F.when(n == 1, F.concat(F.lit("a.EVIL"), k, F.lit(".test."))).otherwise(F.concat(F.lit("notevil"), k, F.lit(".test")))
    own = F.when(n == 0, F.concat(F.lit("www.BÜCHER"), k, F.lit(".test."))).otherwise(host)
    return A.denied_rows(pages.select("page_id", own.alias("host")), deny, "page_id")


def _dns(spark, sf_dir):
    """Two or three addresses per host; some hosts have a private one, some none."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "//([^/?#]*)", 1).alias("host"))
    hosts = pages.groupBy("host").agg(F.min("page_id").alias("k")).filter("k % 8 <> 3")
    return hosts.select("host", F.explode(F.expr(
        "array(struct(1 AS ord, '93.184.' || (k % 200) || '.7' AS ip), struct(2 AS ord, CASE WHEN k % 5 = 0 THEN '10.0.0.' || (k % 256) ELSE '8.8.' || (k % 256) || '.1' END AS ip), "
        "struct(3 AS ord, CASE WHEN k % 7 = 1 THEN '203.0.114.10' ELSE '2606:4700::' || (k % 1000) END AS ip))"
    )).alias("r")).select("host", "r.ord", "r.ip")


@query("resolved_hosts", """
  WITH h AS (SELECT page_id, regexp_extract(url, '//([^/?#]*)', 1) AS host FROM pages), k AS (SELECT host, min(page_id) AS k FROM h GROUP BY host)
  SELECT page_id, host, reason, CASE WHEN reason IS NULL THEN '93.184.' || (k % 200) || '.7' END AS ip FROM (
    SELECT page_id, host, k, CASE WHEN k % 8 = 3 THEN 'dns_resolution_failed' WHEN k % 5 = 0 THEN 'private_address' WHEN k % 7 = 1 THEN 'own_address' END AS reason
    FROM h JOIN k USING (host))
""")
def resolved_hosts(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return A.vet_resolved(pages, _dns(spark, sf_dir), key="page_id", own=["203.0.114.10"])


@query("resolved_hosts_table", SQL["resolved_hosts"])
def resolved_hosts_table(spark, sf_dir):
    """The same verdicts with the table of blocks."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return A.vet_resolved(pages, _dns(spark, sf_dir), key="page_id", own=["203.0.114.10"], blocks=I.block_table(I.fixed_blocks(spark)))


def _hops(spark, sf_dir):
    """Two pages in three redirect to the page three further on; some to refused targets."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    target = pages.select((F.col("page_id") - 3).alias("page_id"), F.col("url").alias("to"))
    rows = pages.filter("page_id % 7 <> 2").join(target, "page_id")
    place = F.when(F.col("page_id") % 13 == 4, "ftp://files.test/x").otherwise(F.col("to"))
    return rows.select("url", place.alias("location"))


@query("redirects", """
  WITH RECURSIVE nx AS (SELECT p.url, CASE WHEN p.page_id % 13 = 4 THEN 'ftp://files.test/x' ELSE q.url END AS location
    FROM pages p JOIN pages q ON q.page_id = p.page_id + 3 WHERE p.page_id % 7 <> 2),
  walk AS (SELECT page_id, 0 AS step, url AS cur, CAST([] AS VARCHAR[]) AS chain, CAST(NULL AS VARCHAR) AS reason FROM pages
    UNION ALL SELECT page_id, step + 1, location, list_append(chain, cur), CASE WHEN step = 3 THEN 'too_many_redirects' WHEN location LIKE 'ftp%' THEN 'scheme_not_allowed' END
    FROM walk JOIN nx ON walk.cur = nx.url WHERE reason IS NULL AND step < 4)
  SELECT page_id, cur AS final_url, len(chain)::INTEGER AS n_hops, array_to_string(chain, ' ') AS hops, reason
  FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY step DESC) AS rn FROM walk) WHERE rn = 1
""")
def redirects(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    out = CR.follow_redirects(pages, _hops(spark, sf_dir), key="page_id")
    return out.select("page_id", "final_url", F.size("chain").alias("n_hops"), F.array_join("chain", " ").alias("hops"), "reason")


_ROBOTS_CASE = """CASE page_id % 6 WHEN 0 THEN 'User-agent: *\\nDisallow: /' WHEN 1 THEN 'User-agent: *\\nDisallow: /admin # no'
  WHEN 2 THEN 'User-agent: bot\\nDisallow: /' WHEN 3 THEN 'User-agent: *\\nDisallow: /a\\n\\nUser-agent: x\\nDisallow: /'
  WHEN 4 THEN 'user-AGENT :  * \\nAllow: /x\\nDISALLOW:/ # all' END"""


@query("robots", "SELECT page_id, CAST(CASE page_id % 6 WHEN 0 THEN 0 WHEN 4 THEN 0 WHEN 5 THEN NULL ELSE 1 END AS INTEGER) AS allowed FROM pages")
def robots(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", F.expr(_ROBOTS_CASE).alias("robots"))
    return rows.select("page_id", CR.robots_allowed(F.col("robots")).alias("allowed"))


# --- rate limit ----------------------------------------------------------------------------------

_LIMIT_SQL = """
  WITH RECURSIVE r AS (SELECT user_id % 40 AS s, event_id, epoch_us(ts) AS t_us,
      row_number() OVER (PARTITION BY user_id % 40 ORDER BY epoch_us(ts), event_id) AS rn FROM events),
  w AS (SELECT s, event_id, t_us, rn, t_us AS opened, 3 - 1 AS left_, true AS granted FROM r WHERE rn = 1
    UNION ALL SELECT r.s, r.event_id, r.t_us, r.rn, CASE WHEN r.t_us - opened > 7200000000 THEN r.t_us ELSE opened END,
      CASE WHEN r.t_us - opened > 7200000000 THEN 3 - 1 WHEN left_ > 0 THEN left_ - 1 ELSE 0 END,
      r.t_us - opened > 7200000000 OR left_ > 0 FROM w JOIN r ON r.s = w.s AND r.rn = w.rn + 1)
  SELECT s AS session, event_id AS request, granted, CAST(left_ AS INTEGER) AS remaining FROM w
"""


@query("rate_limit", _LIMIT_SQL)
def rate_limit(spark, sf_dir):
    """Three grants per two hours for forty sessions, so that many requests are refused."""
    rows = table(spark, sf_dir, "events").withColumn("s", F.col("user_id") % 40)
    out = RL.grant_batch(rows, session="s", request="event_id", at="ts", limit=3, window_seconds=7200)
    return out.select("session", "request", "granted", "remaining")
