"""Scale paths against plain ones, invariance of the transform, models, samples."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalog import fit_queries as FQ
from catalog import model_queries as MQ
from catalog.fixtures import raw_lineitem, table
from urlsift import contract as C
from urlsift.operators import evaluate as E
from urlsift.operators import fit as FT
from urlsift.operators import knn as KN
from urlsift.operators import naive_bayes as NB
from urlsift.operators import oversample as OS
from urlsift.operators import sampling as S
from urlsift.operators import transform as TR
from urlsift.operators.agreement import spearman, value_pairs
from urlsift.operators.ordering import positions
from urlsift.operators.quantiles import exact_quantiles
from urlsift.runtime import lookup_join
from urlsift.sources import files, store


def test_bracketed_quantiles_are_exact(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("hot", F.when(F.col("l_orderkey") % 3 == 0, 7.0).otherwise(F.col("l_tax")))
    cols, probs = ["l_extendedprice", "l_quantity", "hot"], [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    plain = exact_quantiles(rows, cols, probs)
    narrow = exact_quantiles(rows, cols, probs, small_cells=0, inside_rows=50, accuracy=200)
    data = rows.select(*cols).toPandas()
    for c in cols:
        want = [float(np.percentile(data[c], 100 * p)) for p in probs]
        assert plain[c] == pytest.approx(want) and narrow[c] == pytest.approx(want)


def test_positions_by_ranges(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, 0.5).otherwise((F.col("id") * 37 % 997) / 997.0).alias("v"))
    for down in (False, True):
        a = {r["id"]: r["position"] for r in positions(df, "v", tie=["id"], descending=down).collect()}
        b = {r["id"]: r["position"] for r in positions(df, "v", tie=["id"], descending=down, rows_per_range=300).collect()}
        assert a == b and sorted(a.values()) == list(range(1, 5001))


def test_average_precision_by_ranges(spark):
    df = spark.range(3000).select("id", (F.col("id") % 4 != 0).cast("int").alias("y"),
                                  F.when(F.col("id") % 3 == 0, 1.0).otherwise((F.col("id") * 31 % 50) / 50.0).alias("s"))
    want = E.average_precision(df, "y", "s", ["id"]).first()[0]
    rows = sorted(df.collect(), key=lambda r: (-r["s"], r["id"]))
    hits, total = 0, 0.0
    for rank, r in enumerate(rows, 1):
        if r["y"] == 0:
            hits += 1
            total += hits / rank
    assert want == pytest.approx(total / hits)
    assert E.average_precision(df, "y", "s", ["id"], rows_per_range=200).first()[0] == pytest.approx(want)


def test_spearman_by_ranges(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_quantity").alias("x_expected"), F.col("l_tax").alias("x_actual"))
    pairs = value_pairs(rows, ["x"])
    want = rows.toPandas().corr(method="spearman").iloc[0, 1]
    assert spearman(pairs).first()["rho"] == pytest.approx(want)
    assert spearman(pairs, rows_per_range=10).first()["rho"] == pytest.approx(want)


def test_salted_lookup_equals_broadcast(spark):
    big = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("k"))
    small = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    a = lookup_join(big, small, ["k"]).select("id", "k", "v").collect()
    b = lookup_join(big, small, ["k"], limit=5).select("id", "k", "v").collect()
    assert sorted(a) == sorted(b) and len(a) == 1000


@pytest.fixture(scope="module")
def pages(spark, sf):
    return FQ.raw_pages(spark, sf), FQ.page_stats(spark, sf)


def vectors(df, stats):
    out = TR.to_vector(TR.transform(df, stats), C.FEATURES)
    return {r["id"]: tuple(r["features"]) for r in out.collect()}


def test_transform_does_not_depend_on_the_batch(pages):
    rows, stats = pages
    whole = vectors(rows, stats)
    assert vectors(rows.filter("id % 2 = 0"), stats) == {k: v for k, v in whole.items() if k % 2 == 0}
    assert vectors(rows.filter("id = 7"), stats) == {7: whole[7]}
    assert vectors(rows.repartition(5).select(*sorted(rows.columns)), stats) == whole
    assert vectors(rows.unionByName(rows), stats) == whole


def test_empty_record_gets_finite_values(spark, pages):
    _, stats = pages
    cols = [F.lit(1).cast("long").alias("id")]
    cols += [F.lit(None).cast("string" if c in C.TEXT else "double").alias(c) for c in C.WORKING]
    (vector,) = vectors(spark.range(1).select(*cols), stats).values()
    assert all(v is not None and np.isfinite(v) for v in vector)
    with pytest.raises(C.ContractError):
        TR.transform(spark.range(1).select(*cols[:-1]), stats)


def test_joined_cascade_equals_literals(pages):
    rows, stats = pages
    staged = FT.stage_records(rows, stats)
    small = FT.fit_cascade(staged, stats.spec, literal_keys=4)
    large = FT.fit_cascade(staged, stats.spec)
    assert [m.overall for m in small] == [m.overall for m in large]
    assert any(m.table is not None for m in small) and all(m.table is None for m in large)
    from dataclasses import replace

    def filled(steps):
        out = FT.replay_cascade(staged, replace(stats, cascade=steps), count_missed=True)
        return sorted(out.select("id", *C.BINARY, *[f"_missed_{c}" for c in C.CASCADE_ORDER]).collect())

    assert filled(small) == filled(large)


def test_statistics_survive_storage(spark, pages, tmp_path):
    rows, stats = pages
    store.save_stats(spark, stats, str(tmp_path / "s"))
    loaded = store.load_stats(spark, str(tmp_path / "s"))
    assert vectors(rows, loaded) == vectors(rows, stats)
    model = MQ.line_model(spark, "/root/testdata/sf0.001")
    store.save_naive_bayes(spark, model, str(tmp_path / "nb"))
    assert store.load_naive_bayes(spark, str(tmp_path / "nb")) == model
    from dataclasses import replace

    with pytest.raises(store.VersionError):
        store.load_stats(spark, str(tmp_path / "s"), replace(stats.spec, features=stats.spec.features[1:]))


def test_batch_stream_and_crawl_scores_agree(spark, sf):
    from catalog import plan_queries as PQ
    from urlsift.plans import scoring

    rows, stats, models = FQ.raw_pages(spark, sf), FQ.page_stats(spark, sf), MQ.page_models(spark, sf)
    batch = sorted(scoring.score_records(rows, stats, models).collect())
    stream = PQ.QUERIES["score_stream"](spark, sf)
    assert sorted(stream.select(*scoring.score_records(rows, stats, models).columns).collect()) == batch
    served = PQ.QUERIES["serve_crawl"](spark, sf).collect()
    assert len(served) == rows.count()
    assert all((r["verdict"] == "insufficient evidence") == r["abstained"] for r in served)


def brute(q, ref, ids, k, power):
    d = (np.abs(q[:, None, :].astype(float) - ref[None].astype(float)) ** power).sum(-1)
    return [[int(ids[j]) for j in np.lexsort((ids, row))[:k]] for row in d]


@pytest.mark.parametrize("metric,power", [("euclidean", 2), ("manhattan", 1), ("minkowski", 3)])
def test_nearest_against_brute_force(spark, metric, power):
    rng = np.random.default_rng(1)
    ref = np.round(rng.normal(size=(300, 6)), 0).astype("float32")  # many exact ties
    q = np.concatenate([ref[:20], rng.normal(size=(20, 6)).astype("float32")])
    refs = spark.createDataFrame([(i, i % 2, v.tolist()) for i, v in enumerate(ref)], "id long, label int, features array<float>")
    asks = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "qid long, features array<float>")
    want = brute(q, ref, np.arange(300), 7, power)
    for options in ({}, {"bound": 0, "block_rows": 64}):
        found = KN.nearest(asks, refs, keys=["qid"], k=7, metric=metric, p=power, **options)
        got = {r["qid"]: [n["ref_id"] for n in r["neighbours"]] for r in found.collect()}
        assert [got[i] for i in range(40)] == want


def test_vote_ties_and_parameters(spark):
    df = spark.createDataFrame([([(1, 1, 0.1), (2, 0, 0.2), (3, 0, 0.3), (4, 1, 0.4)],)],
                               "n array<struct<ref_id: long, label: int, distance: double>>")
    row = df.select(KN.vote(F.col("n"), "nearest").alias("a"), KN.vote(F.col("n"), "lowest").alias("b"),
                    KN.phishing_share(F.col("n")).alias("s")).first()
    assert (row["a"], row["b"], row["s"]) == (1, 0, 0.5)
    for bad in ((0, "euclidean", 1), (True, "euclidean", 1), (3, "cosine", 1), (3, "minkowski", 0)):
        with pytest.raises(ValueError):
            KN.check_parameters(*bad)


def test_smoothed_bayes_equals_the_library(spark, sf):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = MQ.line_matrix(spark, sf).withColumns({c: F.col(c).cast("float").cast("double") for c in MQ.FEATS})
    model = NB.fit_naive_bayes(rows, MQ.FEATS, smoothed=True)
    mine = NB.score(rows, model).select(*FQ.LINE_KEY, "nb_label", "nb_score")
    data = rows.withColumn("features", array_to_vector(F.array(*MQ.FEATS)))
    lib = NaiveBayes(modelType="gaussian").fit(data).transform(data).select(
        *FQ.LINE_KEY, vector_to_array("probability")[0].alias("p0")
    )
    gap = mine.join(lib, list(FQ.LINE_KEY)).agg(F.max(F.abs(F.col("nb_score") - F.col("p0")))).first()[0]
    assert gap < 1e-6


def test_smote_invariants(spark, sf):
    df = MQ._smote_input(spark, sf)
    out = OS.smote(df, key="id").cache()
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts[0] == counts[1]
    made = out.filter("origin is not null").collect()
    base = {r["id"]: np.array(r["features"], float) for r in df.collect()}
    for r in made:
        a, b = base[r["origin"]], base[r["partner"]]
        assert np.allclose(r["features"], a + r["gap"] * (b - a), atol=1e-5) and r["origin"] != r["partner"]
    again = OS.smote(df.repartition(3), key="id").filter("origin is not null").collect()
    assert sorted((r["origin"], r["partner"], r["gap"]) for r in again) == sorted((r["origin"], r["partner"], r["gap"]) for r in made)


def test_split_is_stable_and_complete(spark, sf):
    rows = table(spark, sf, "lineitem").select(*FQ.LINE_KEY)
    a = S.hash_split(rows, FQ.LINE_KEY)
    b = S.hash_split(rows.repartition(7), FQ.LINE_KEY)
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)
    assert 0.75 < a.filter("split = 'train'").count() / rows.count() < 0.85


def test_empty_stratum_fails(spark):
    df = spark.createDataFrame([(1, "u", "d", 0)], "id long, URL string, Domain string, label int")
    with pytest.raises(ValueError, match="empty strata"):
        S.four_strata(df, 4, ["id"])


def test_compressed_pages(spark, tmp_path):
    import gzip
    import hashlib

    texts = ["<p>é</p>", "plain"]
    names = [hashlib.sha1(t.encode()).hexdigest() for t in texts]
    for n, t in zip(names, texts, strict=True):
        (tmp_path / f"{n}.html.gz").write_bytes(gzip.compress(t.encode()))
    (tmp_path / "00ff.html.gz").write_bytes(b"no gzip")
    got = {r["sha1"]: r["html"] for r in files.read_pages(spark, str(tmp_path)).collect()}
    assert got == {**dict(zip(names, texts, strict=True)), "00ff": None}


def test_rates_with_empty_denominators(spark):
    df = spark.createDataFrame([(1, 1), (1, 1)], "y int, m_pred int")
    r = E.model_metrics(df, "y", ["m"]).first()
    assert (r["phishing_precision"], r["phishing_recall"], r["phishing_f1"], r["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_line_labels_are_not_trivial(spark, sf):
    assert raw_lineitem(spark, sf).select("label").distinct().count() == 2
