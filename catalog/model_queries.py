"""Classifiers and evaluation."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from catalog.fit_queries import (
    LINE_CTES, LINE_SPEC, PAGE_CTES, line_stats, page_stats, raw_pages, _remember,
)
from catalog.fixtures import (
    LINE_KEY, MODELS, PREDICTIONS_SQL, RAW_LINEITEM_SQL, predictions, raw_lineitem, table,
)
from urlsift import contract as C
from urlsift.operators import evaluate as E
from urlsift.operators import knn as KN
from urlsift.operators import naive_bayes as NB
from urlsift.operators import oversample as OS
from urlsift.operators import transform as TR
from urlsift.plans import scoring

QUERIES, SQL = {}, {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


KEYS = ", ".join(LINE_KEY)
FEATS = LINE_SPEC.features


def line_matrix(spark, sf_dir):
    return TR.transform(raw_lineitem(spark, sf_dir), line_stats(spark, sf_dir), ["label", "split"])


def line_model(spark, sf_dir, smoothed=False):
    return _remember(
        f"nb{smoothed}", spark, sf_dir,
        lambda: NB.fit_naive_bayes(line_matrix(spark, sf_dir).filter("split = 'train'"), FEATS, smoothed=smoothed),
    )


# --- naive Bayes ------------------------------------------------------------------------------

def _f(c):
    return f"CAST(CAST(\"{c}\" AS FLOAT) AS DOUBLE)"


def _nb_ctes(smoothed):
    per = ", ".join(
        f"avg({_f(c)}) AS m{i}, "
        + (f"var_pop({_f(c)}) AS s{i}" if smoothed else
           f"CASE WHEN coalesce(stddev_samp({_f(c)}), 0) = 0 THEN 1e-10 ELSE stddev_samp({_f(c)}) END AS s{i}")
        for i, c in enumerate(FEATS)
    )
    big = "greatest(" + ", ".join(f"var_pop({_f(c)})" for c in FEATS) + ") * 1e-9"
    nb = f"nb0 AS (SELECT label AS k, ln(count(*) / CAST((SELECT count(*) FROM scaled WHERE split = 'train') AS DOUBLE)) AS lp, {per} FROM scaled WHERE split = 'train' GROUP BY label)"
    if smoothed:
        final = "nb AS (SELECT k, lp, " + ", ".join(
            f"m{i}, sqrt(s{i} + (SELECT {big} FROM scaled WHERE split = 'train')) AS s{i}" for i in range(len(FEATS))
        ) + " FROM nb0)"
    else:
        final = "nb AS (SELECT * FROM nb0)"
    joint = " + ".join(
        f"(-0.5e0 * (ln(2 * pi()) + 2 * ln(s{i})) - 0.5e0 * pow(({_f(c)} - m{i}) / s{i}, 2))" for i, c in enumerate(FEATS)
    )
    jll = (
        f"jll AS (SELECT {KEYS}, label, split, max(CASE WHEN k = 0 THEN j END) AS l0, max(CASE WHEN k = 1 THEN j END) AS l1 "
        f"FROM (SELECT {', '.join('s.' + k for k in LINE_KEY)}, s.label, s.split, k, lp + {joint} AS j FROM scaled s, nb) GROUP BY ALL)"
    )
    return LINE_CTES + f", {nb}, {final}, {jll}"


def _nb_table_sql(smoothed):
    return _nb_ctes(smoothed) + " " + " UNION ALL ".join(
        f"SELECT k AS label, '{c}' AS feature, round(m{i}, 6) AS mean, round(s{i}, 6) AS std, round(lp, 6) AS log_prior FROM nb"
        for i, c in enumerate(FEATS)
    )


def _model_rows(spark, model):
    return model.table(spark).select(
        "label", "feature", *[F.round(c, 6).alias(c) for c in ("mean", "std", "log_prior")]
    )


@query("nb_fit", _nb_table_sql(False))
def nb_fit(spark, sf_dir):
    return _model_rows(spark, line_model(spark, sf_dir))


@query("nb_fit_smoothed", _nb_table_sql(True))
def nb_fit_smoothed(spark, sf_dir):
    return _model_rows(spark, line_model(spark, sf_dir, True))


@query("nb_log_joint", _nb_ctes(False) + f" SELECT {KEYS}, round(l0, 5) AS l0, round(l1, 5) AS l1 FROM jll")
def nb_log_joint(spark, sf_dir):
    model = line_model(spark, sf_dir)
    return line_matrix(spark, sf_dir).select(
        *LINE_KEY, F.round(NB.log_joint(model, 0), 5).alias("l0"), F.round(NB.log_joint(model, 1), 5).alias("l1")
    )


_SCORED = (
    " SELECT {keys}, CAST(CASE WHEN l0 >= l1 THEN 0 ELSE 1 END AS INTEGER) AS nb_label, "
    "round(exp(l0 - greatest(l0, l1)) / (exp(l0 - greatest(l0, l1)) + exp(l1 - greatest(l0, l1))), 6) AS nb_score FROM jll"
)


def _scored(spark, sf_dir, smoothed):
    out = NB.score(line_matrix(spark, sf_dir), line_model(spark, sf_dir, smoothed))
    return out.select(*LINE_KEY, "nb_label", F.round("nb_score", 6).alias("nb_score"))


@query("nb_score", _nb_ctes(False) + _SCORED.format(keys=KEYS))
def nb_score(spark, sf_dir):
    return _scored(spark, sf_dir, False)


@query("nb_score_smoothed", _nb_ctes(True) + _SCORED.format(keys=KEYS))
def nb_score_smoothed(spark, sf_dir):
    return _scored(spark, sf_dir, True)


def _product_sql():
    def product(k):
        return f"exp(max(CASE WHEN k = {k} THEN lp END)) * max(CASE WHEN k = {k} THEN p END)"

    dens = " * ".join(
        f"(1 / (sqrt(2 * pi()) * s{i}) * exp(-pow({_f(c)} * 40 - m{i}, 2) / (2 * s{i} * s{i})))" for i, c in enumerate(FEATS)
    )
    return _nb_ctes(False) + (
        f" SELECT count(*) AS n_rows, count(*) FILTER (WHERE p0 + p1 = 0) AS underflowed FROM (SELECT {KEYS}, {product(0)} AS p0, {product(1)} AS p1 "
        f"FROM (SELECT {', '.join('s.' + k for k in LINE_KEY)}, k, lp, {dens} AS p FROM scaled s, nb) GROUP BY ALL)"
    )


@query("nb_underflow", _product_sql())
def nb_underflow(spark, sf_dir):
    """Rows pushed 40 times away from the mean, so that many products underflow."""
    far = line_matrix(spark, sf_dir).withColumns(
        {c: F.col(c).cast("float").cast("double") * 40 for c in FEATS}
    )
    model = line_model(spark, sf_dir)
    return NB.underflow_audit(far, model)


@query("nb_threshold", _nb_ctes(False) + f" SELECT {KEYS}, CAST(CASE WHEN sc >= 0.2 THEN 0 ELSE 1 END AS INTEGER) AS label_at FROM "
       f"(SELECT {KEYS}, 1 / (1 + exp(l1 - l0)) AS sc FROM jll)")
def nb_threshold(spark, sf_dir):
    out = NB.score(line_matrix(spark, sf_dir), line_model(spark, sf_dir))
    return out.select(*LINE_KEY, E.threshold_label(F.col("nb_score"), 0.2).alias("label_at"))


# --- nearest neighbours -----------------------------------------------------------------------

def _points(spark, sf_dir):
    pts = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.when(F.col("label") != 0, 1).otherwise(0).alias("label"),
        F.col("embedding").alias("features"),
    )
    return pts.filter("id % 5 = 0"), pts.filter("id % 5 > 0")


def _knn_sql(distance, k):
    return f"""
      WITH pts AS (SELECT vec_id AS id, CAST(CASE WHEN label <> 0 THEN 1 ELSE 0 END AS INTEGER) AS label,
        CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
      ranked AS (SELECT q.id AS query_id, r.id AS ref_id, r.label, {distance} AS distance,
        row_number() OVER (PARTITION BY q.id ORDER BY {distance}, r.id) AS rn
        FROM pts q, pts r WHERE q.id % 5 = 0 AND r.id % 5 > 0),
      near AS (SELECT * FROM ranked WHERE rn <= {k})
    """


_EUCLID = "list_distance(q.v, r.v)"
_MANHATTAN = "list_sum(list_transform(range(1, len(q.v) + 1), lambda i: abs(q.v[i] - r.v[i])))"
_MINKOWSKI = "pow(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: pow(abs(q.v[i] - r.v[i]), 3))), 1 / 3e0)"
_NEAR = (
    "SELECT query_id, CAST(rn AS INTEGER) AS rank, ref_id, label, round(distance, 5) AS distance FROM near"
)


def _neighbour_rows(spark, sf_dir, **options):
    queries, refs = _points(spark, sf_dir)
    found = KN.nearest(queries, refs, keys=["id"], **options)
    rows = found.select(F.col("id").alias("query_id"), F.posexplode("neighbours").alias("p", "n"))
    return rows.select(
        "query_id", (F.col("p") + 1).alias("rank"), F.col("n.ref_id").alias("ref_id"),
        F.col("n.label").alias("label"), F.round("n.distance", 5).alias("distance"),
    )


@query("knn_euclidean", _knn_sql(_EUCLID, 20) + _NEAR)
def knn_euclidean(spark, sf_dir):
    return _neighbour_rows(spark, sf_dir, k=20)


@query("knn_manhattan", _knn_sql(_MANHATTAN, 6) + _NEAR)
def knn_manhattan(spark, sf_dir):
    return _neighbour_rows(spark, sf_dir, k=6, metric="manhattan")


@query("knn_minkowski", _knn_sql(_MINKOWSKI, 6) + _NEAR)
def knn_minkowski(spark, sf_dir):
    return _neighbour_rows(spark, sf_dir, k=6, metric="minkowski", p=3)


@query("knn_blocked", _knn_sql(_EUCLID, 20) + _NEAR)
def knn_blocked(spark, sf_dir):
    """The same answer from reference blocks, as used beyond the bounded reference set."""
    return _neighbour_rows(spark, sf_dir, k=20, bound=0, block_rows=90)


_HOLED = "q.id % 50 <> 0 AND r.id % 7 <> 1 AND "


@query("knn_holes", _knn_sql(_EUCLID, 5).replace("WHERE q.id", f"WHERE {_HOLED}q.id")
       + "SELECT p.id AS query_id, list(n.ref_id ORDER BY rn) FILTER (rn IS NOT NULL) AS refs, max(rn) IS NULL AS empty FROM pts p LEFT JOIN near n ON n.query_id = p.id WHERE p.id % 5 = 0 GROUP BY p.id")
def knn_holes(spark, sf_dir):
    """NULL reference vectors are no neighbours, NULL query vectors have none; by pivots."""
    queries, refs = _points(spark, sf_dir)
    queries = queries.withColumn("features", F.when(F.col("id") % 50 != 0, F.col("features")))
    refs = refs.withColumn("features", F.when(F.col("id") % 7 != 1, F.col("features")))
    found = KN.nearest(queries, refs, keys=["id"], k=5, bound=0, block_rows=90)
    ids = F.transform("neighbours", lambda n: n["ref_id"])
    return found.select(F.col("id").alias("query_id"), F.when(F.size(ids) > 0, ids).alias("refs"), (F.size(ids) == 0).alias("empty"))


#: Supplier balances and customers' places in the plane of nation and balance: points that lie in groups.
_PLACES = "SELECT c_custkey AS id, [CAST(c_nationkey * 1000 AS DOUBLE), CAST(c_acctbal AS DOUBLE)] AS v FROM customer"


@query("knn_pruned", f"""WITH pts AS ({_PLACES}), ranked AS (
    SELECT q.id AS query_id, r.id AS ref_id, row_number() OVER (PARTITION BY q.id ORDER BY list_distance(q.v, r.v), r.id) AS rn
    FROM pts q, pts r WHERE q.id % 10 = 0 AND r.id % 10 > 0)
  SELECT query_id, list(ref_id ORDER BY rn) AS refs, true AS pruned FROM ranked WHERE rn <= 5 GROUP BY query_id""")
def knn_pruned(spark, sf_dir):
    """Neighbours by pivots, and whether a query was compared with fewer than half of the references."""
    pts = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.lit(0).alias("label"),
        F.array((F.col("c_nationkey") * 1000).cast("float"), F.col("c_acctbal").cast("float")).alias("features"),
    )
    refs = pts.filter("id % 10 > 0")
    found = KN.nearest(pts.filter("id % 10 = 0"), refs, keys=["id"], k=5, bound=0, block_rows=100, scored=True)
    few = F.col("scored") * 2 < F.lit(refs.count())
    return found.select(F.col("id").alias("query_id"), F.transform("neighbours", lambda n: n["ref_id"]).alias("refs"), few.alias("pruned"))


@query("knn_equal_keys", _knn_sql(_EUCLID, 5) + "SELECT query_id % 3 AS grp, list(ref_id ORDER BY rn) AS refs FROM near GROUP BY query_id")
def knn_equal_keys(spark, sf_dir):
    """Queries that share a key are answered each, by reference blocks."""
    queries, refs = _points(spark, sf_dir)
    found = KN.nearest(queries.withColumn("grp", F.col("id") % 3), refs, keys=["grp"], k=5, bound=0, block_rows=90)
    return found.select("grp", F.transform("neighbours", lambda n: n["ref_id"]).alias("refs"))


@query("knn_reference", "SELECT vec_id AS id, label FROM (SELECT *, row_number() OVER (ORDER BY vec_id) rn FROM embeddings WHERE vec_id % 5 > 0) WHERE rn <= 10000")
def knn_reference(spark, sf_dir):
    refs = table(spark, sf_dir, "embeddings").filter("vec_id % 5 > 0")
    return KN.reference_set(refs, ["vec_id"]).select(F.col("vec_id").alias("id"), "label")


_VOTE = """, votes AS (SELECT query_id, label, count(*) AS n, min(rn) AS first FROM near GROUP BY query_id, label)
  SELECT query_id, label FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY n DESC, {tie}) AS o FROM votes) WHERE o = 1"""


def _votes(spark, sf_dir, k, ties):
    queries, refs = _points(spark, sf_dir)
    found = KN.nearest(queries, refs, keys=["id"], k=k)
    return found.select(F.col("id").alias("query_id"), KN.vote(F.col("neighbours"), ties).alias("label"))


@query("knn_vote_nearest", _knn_sql(_EUCLID, 6) + _VOTE.format(tie="first"))
def knn_vote_nearest(spark, sf_dir):
    return _votes(spark, sf_dir, 6, "nearest")


@query("knn_vote_lowest", _knn_sql(_EUCLID, 6) + _VOTE.format(tie="label"))
def knn_vote_lowest(spark, sf_dir):
    return _votes(spark, sf_dir, 6, "lowest")


@query("knn_score", _knn_sql(_EUCLID, 20) + " SELECT query_id, avg(CASE WHEN label = 0 THEN 1e0 ELSE 0e0 END) AS score FROM near GROUP BY query_id")
def knn_score(spark, sf_dir):
    queries, refs = _points(spark, sf_dir)
    found = KN.nearest(queries, refs, keys=["id"], k=20)
    return found.select(F.col("id").alias("query_id"), KN.phishing_share(F.col("neighbours")).alias("score"))


def page_models(spark, sf_dir):
    def make():
        stats = page_stats(spark, sf_dir)
        return scoring.fit_models(raw_pages(spark, sf_dir).filter("split = 'train'"), stats)

    return _remember("page-models", spark, sf_dir, make)


@query("score_pages")
def score_pages(spark, sf_dir):
    """All four models on every page record: labels and scores (checked by tests)."""
    stats, models = page_stats(spark, sf_dir), page_models(spark, sf_dir)
    return scoring.score_records(raw_pages(spark, sf_dir).drop("URL"), stats, models)


# --- evaluation -----------------------------------------------------------------------------------

def _ratio(a, b):
    return f"coalesce({a} / nullif(CAST({b} AS DOUBLE), 0), 0)"


def _metrics_sql(src, by=""):
    prefix = f"{by}, " if by else ""
    parts = [
        f"SELECT {prefix}'{m}' AS model, count(*) FILTER (WHERE y_true = 0 AND {m}_pred = 0) AS tp, "
        f"count(*) FILTER (WHERE y_true = 0 AND {m}_pred = 1) AS fn, count(*) FILTER (WHERE y_true = 1 AND {m}_pred = 0) AS fp, "
        f"count(*) FILTER (WHERE y_true = 1 AND {m}_pred = 1) AS tn FROM ({src}) {'GROUP BY ' + by if by else ''}" for m in MODELS
    ]
    return f"""
      SELECT *, accuracy - baseline_accuracy AS lift_over_baseline,
        {_ratio('2 * phishing_precision * phishing_recall', '(phishing_precision + phishing_recall)')} AS phishing_f1,
        {_ratio('2 * legitimate_precision * legitimate_recall', '(legitimate_precision + legitimate_recall)')} AS legitimate_f1
      FROM (SELECT *, {_ratio('(tp + tn)', '(tp + fn + fp + tn)')} AS accuracy, 0.9248::DOUBLE AS baseline_accuracy,
        {_ratio('tp', '(tp + fp)')} AS phishing_precision, {_ratio('tp', '(tp + fn)')} AS phishing_recall,
        {_ratio('tn', '(tn + fn)')} AS legitimate_precision, {_ratio('tn', '(tn + fp)')} AS legitimate_recall,
        {_ratio('fn', '(tp + fn)')} AS missed_share, tp + fn AS support_phishing, fp + tn AS support_legitimate
      FROM ({' UNION ALL '.join(parts)}))
    """


RATES = ("accuracy", "baseline_accuracy", "phishing_precision", "phishing_recall", "phishing_f1",
         "legitimate_precision", "legitimate_recall", "legitimate_f1", "lift_over_baseline", "missed_share")
COUNTS = ("tp", "fn", "fp", "tn", "support_phishing", "support_legitimate")


@query("confusion", f"SELECT model, tp, fn, fp, tn FROM ({_metrics_sql(PREDICTIONS_SQL)})")
def confusion(spark, sf_dir):
    return E.model_metrics(predictions(spark, sf_dir), "y_true", MODELS).select("model", "tp", "fn", "fp", "tn")


@query("model_metrics", f"SELECT model, {', '.join(COUNTS)}, {', '.join(f'round({r}, 9) AS {r}' for r in RATES)} FROM ({_metrics_sql(PREDICTIONS_SQL)})")
def model_metrics(spark, sf_dir):
    m = E.model_metrics(predictions(spark, sf_dir), "y_true", MODELS)
    return m.select("model", *COUNTS, *[F.round(r, 9).alias(r) for r in RATES])


@query("missed_share", f"SELECT model, round(missed_share, 9) AS missed_share FROM ({_metrics_sql(PREDICTIONS_SQL)})")
def missed_share(spark, sf_dir):
    return E.model_metrics(predictions(spark, sf_dir), "y_true", MODELS).select(
        "model", F.round("missed_share", 9).alias("missed_share")
    )


@query("baseline_lift", f"SELECT model, round({_ratio('(tp + tn)', '(tp + fn + fp + tn)')} - "
       f"{_ratio('greatest(tp + fn, fp + tn)', '(tp + fn + fp + tn)')}, 9) AS lift FROM ({_metrics_sql(PREDICTIONS_SQL)})")
def baseline_lift(spark, sf_dir):
    m = E.model_metrics(predictions(spark, sf_dir), "y_true", MODELS, baseline=None)
    return m.select("model", F.round("lift_over_baseline", 9).alias("lift"))


def _curve_sql(model, n):
    step = 1.0 / (n - 1)
    return f"""
      WITH p AS ({PREDICTIONS_SQL}), t AS (SELECT i, CASE WHEN i = {n - 1} THEN 1e0 ELSE i * {step!r}::DOUBLE END AS th FROM range({n}) r(i)),
      d AS (SELECT {model}_score AS s, count(*) FILTER (WHERE y_true = 0) AS pos, count(*) AS n FROM p GROUP BY 1)
      SELECT round(th, 9) AS threshold, round({_ratio('sum(pos) FILTER (WHERE s >= th)', 'sum(n) FILTER (WHERE s >= th)')}, 9) AS precision,
        round({_ratio('sum(pos) FILTER (WHERE s >= th)', 'sum(pos)')}, 9) AS recall FROM t, d GROUP BY th
    """


def _curve(spark, sf_dir, model, n):
    curve = E.precision_recall_curve(predictions(spark, sf_dir), "y_true", f"{model}_score", n)
    return curve.select(*[F.round(c, 9).alias(c) for c in ("threshold", "precision", "recall")])


@query("pr_curve", _curve_sql("knn_vote", 101))
def pr_curve(spark, sf_dir):
    return _curve(spark, sf_dir, "knn_vote", 101)


@query("threshold_sweep", _curve_sql("nb_smooth", 51))
def threshold_sweep(spark, sf_dir):
    return _curve(spark, sf_dir, "nb_smooth", 51)


@query("metrics_at_threshold", f"SELECT count(*) FILTER (WHERE y_true = 0 AND nb_floor_score >= 0.35) AS tp, "
       f"count(*) FILTER (WHERE y_true = 0 AND NOT nb_floor_score >= 0.35) AS fn, count(*) FILTER (WHERE y_true = 1 AND nb_floor_score >= 0.35) AS fp, "
       f"count(*) FILTER (WHERE y_true = 1 AND NOT nb_floor_score >= 0.35) AS tn FROM ({PREDICTIONS_SQL})")
def metrics_at_threshold(spark, sf_dir):
    rows = predictions(spark, sf_dir).withColumn("at_pred", E.threshold_label(F.col("nb_floor_score"), 0.35))
    return E.model_metrics(rows, "y_true", ["at"]).select("tp", "fn", "fp", "tn")


def _ap_sql():
    parts = [
        f"SELECT '{m}' AS model, round(coalesce(avg(CASE WHEN y_true = 0 THEN tp / CAST(rk AS DOUBLE) END), 0), 9) AS average_precision FROM ("
        f"SELECT y_true, row_number() OVER w AS rk, sum(CASE WHEN y_true = 0 THEN 1 ELSE 0 END) OVER (w ROWS UNBOUNDED PRECEDING) AS tp "
        f"FROM p WINDOW w AS (ORDER BY {m}_score DESC, mix, {KEYS}))" for m in MODELS
    ]
    return f"WITH p AS ({PREDICTIONS_SQL}) " + " UNION ALL ".join(parts)


@query("average_precision_nulls", f"WITH p AS (SELECT *, CASE WHEN mix % 7 > 0 THEN knn_vote_score END AS s FROM ({PREDICTIONS_SQL})) "
       "SELECT round(avg(CASE WHEN y_true = 0 THEN tp / CAST(rk AS DOUBLE) END), 9) AS average_precision FROM (SELECT y_true, "
       "row_number() OVER w AS rk, sum(CASE WHEN y_true = 0 THEN 1 ELSE 0 END) OVER (w ROWS UNBOUNDED PRECEDING) AS tp FROM p "
       f"WINDOW w AS (ORDER BY s DESC NULLS LAST, mix, {KEYS}))")
def average_precision_nulls(spark, sf_dir):
    """Rows without a score come last, over many ranges."""
    rows = predictions(spark, sf_dir).withColumn("s", F.when(F.col("mix") % 7 > 0, F.col("knn_vote_score")))
    found = E.average_precision(rows, "y_true", "s", ["mix", *LINE_KEY], rows_per_range=500)
    return found.select(F.round("average_precision", 9).alias("average_precision"))


@query("average_precision", _ap_sql())
def average_precision(spark, sf_dir):
    rows = E.average_precision_table(predictions(spark, sf_dir), "y_true", MODELS, ["mix", *LINE_KEY])
    return rows.select("model", F.round("average_precision", 9).alias("average_precision"))


@query("disagreement", f"SELECT 'knn' AS family, round(avg(CASE WHEN knn_vote_pred <> knn_library_pred THEN 1e0 ELSE 0e0 END), 9) AS rate FROM ({PREDICTIONS_SQL}) "
       f"UNION ALL SELECT 'naive_bayes', round(avg(CASE WHEN nb_floor_pred <> nb_smooth_pred THEN 1e0 ELSE 0e0 END), 9) FROM ({PREDICTIONS_SQL})")
def disagreement(spark, sf_dir):
    pairs = {"knn": ("knn_vote_pred", "knn_library_pred"), "naive_bayes": ("nb_floor_pred", "nb_smooth_pred")}
    return E.disagreement(predictions(spark, sf_dir), pairs).withColumn("rate", F.round("rate", 9))


def _report_sql():
    one = f"SELECT * FROM ({_metrics_sql(PREDICTIONS_SQL)}) WHERE model = 'nb_floor'"
    return (
        f"SELECT CAST(0 AS INTEGER) AS label, phishing_precision AS precision, phishing_recall AS recall, phishing_f1 AS f1, support_phishing AS support FROM ({one}) "
        f"UNION ALL SELECT CAST(1 AS INTEGER), legitimate_precision, legitimate_recall, legitimate_f1, support_legitimate FROM ({one})"
    )


@query("class_report", f"SELECT label, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM ({_report_sql()})")
def class_report(spark, sf_dir):
    r = E.class_report(predictions(spark, sf_dir), "y_true", "nb_floor_pred")
    return r.select("label", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("weighted_report", "SELECT " + ", ".join(
    f"round(sum({m} * support) / sum(support), 9) AS weighted_{m}" for m in ("precision", "recall", "f1")) + f" FROM ({_report_sql()})")
def weighted_report(spark, sf_dir):
    r = E.weighted_report(predictions(spark, sf_dir), "y_true", "nb_floor_pred")
    return r.select(*[F.round(c, 9).alias(c) for c in r.columns])


_PROFILED = f"SELECT *, CASE WHEN mix % 2 = 0 THEN 'corrected' ELSE 'leaky' END AS profile FROM ({PREDICTIONS_SQL})"


@query("profile_comparison", f"SELECT model, " + ", ".join(
    f"round(max(CASE WHEN profile = '{p}' THEN {m} END), 9) AS {p}_{m}" for p in ("corrected", "leaky")
    for m in ("accuracy", "phishing_recall")) + f" FROM ({_metrics_sql(_PROFILED, 'profile')}) GROUP BY model")
def profile_comparison(spark, sf_dir):
    rows = predictions(spark, sf_dir).withColumn("profile", F.when(F.col("mix") % 2 == 0, "corrected").otherwise("leaky"))
    m = E.model_metrics(rows, "y_true", MODELS, by=["profile"])
    wide = E.compare_profiles(m, ["accuracy", "phishing_recall"], ["corrected", "leaky"])
    return wide.select("model", *[F.round(c, 9).alias(c) for c in wide.columns if c != "model"])


# --- oversampling -----------------------------------------------------------------------------------

def _smote_input(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.when(F.col("label") != 0, 1).otherwise(0).alias("label"),
        F.col("embedding").alias("features"),
    )


def _smote_sql():
    def uniform(seed):
        return f"CAST('0x' || substr(md5(concat_ws('|', i::VARCHAR, '{seed}')), 1, 10) AS BIGINT)::DOUBLE / 1099511627776e0"

    return f"""
      WITH pts AS (SELECT vec_id AS id, CAST(CASE WHEN label <> 0 THEN 1 ELSE 0 END AS INTEGER) AS label, embedding AS v FROM embeddings),
      sizes AS (SELECT label, count(*) AS n FROM pts GROUP BY label),
      few AS (SELECT * FROM pts WHERE label = (SELECT arg_min(label, n * 10 + label) FROM sizes)),
      placed AS (SELECT *, row_number() OVER (ORDER BY id) AS position FROM few),
      near AS (SELECT q.id AS origin, r.id AS partner, row_number() OVER (PARTITION BY q.id ORDER BY list_distance(q.v::DOUBLE[], r.v::DOUBLE[]), r.id) AS rn
        FROM few q, few r),
      others AS (SELECT origin, list(partner ORDER BY rn)[:5] AS partners FROM near WHERE rn <= 6 AND partner <> origin GROUP BY origin),
      picks AS (SELECT i, CAST(floor({uniform(42)} * (SELECT count(*) FROM few)) AS BIGINT) + 1 AS position, {uniform(43)} AS u, {uniform(44)} AS gap
        FROM (SELECT unnest(range((SELECT max(n) - min(n) FROM sizes)::BIGINT)) AS i)),
      chosen AS (SELECT p.gap, f.id AS origin, f.v AS a, o.partners[CAST(floor(p.u * len(o.partners)) AS BIGINT) + 1] AS partner
        FROM picks p JOIN placed f USING (position) JOIN others o ON o.origin = f.id)
      SELECT id, label, list_transform(v, lambda x: round(x::DOUBLE, 4) + 0.0) AS features, NULL::BIGINT AS origin, NULL::BIGINT AS partner, NULL::DOUBLE AS gap FROM pts
      UNION ALL SELECT NULL, f.label, list_transform(range(1, len(a) + 1), lambda j: round((a[j] + gap * (f.v[j] - a[j]))::FLOAT::DOUBLE, 4) + 0.0),
        origin, partner, gap FROM chosen c JOIN few f ON f.id = c.partner
    """


@query("smote", _smote_sql())
def smote(spark, sf_dir):
    """Minority vectors oversampled to class balance."""
    out = OS.smote(_smote_input(spark, sf_dir), key="id")
    return out.withColumn("features", F.transform("features", lambda x: F.round(x.cast("double"), 4) + F.lit(0.0)))


@query("smote_balance", "SELECT label, CAST((SELECT max(n) FROM (SELECT count(*) AS n FROM embeddings GROUP BY label <> 0)) AS BIGINT) AS n "
       "FROM (VALUES (CAST(0 AS INTEGER)), (CAST(1 AS INTEGER))) v(label)")
def smote_balance(spark, sf_dir):
    return OS.smote(_smote_input(spark, sf_dir), key="id").groupBy("label").agg(F.count("*").alias("n"))
