"""Neighbours of the classifiers are sought among all training rows."""

import pytest
from pyspark.sql import functions as F

from catalog import fit_queries as FQ
from catalog import model_queries as MQ
from catalog import plan_queries as PQ
from catalog.fixtures import raw_lineitem
from urlsift.operators import knn as KN
from urlsift.plans import scoring, training

LARGER = "/root/testdata/sf0.01"


def test_every_training_row_is_a_reference(spark):
    train = raw_lineitem(spark, LARGER).filter(FQ.TRAIN)
    found, n = scoring.fit_models(train, FQ.line_stats(spark, LARGER)).reference, train.count()
    assert n > 40_000 and found.count() == n and found.select("id").distinct().count() == n


class Seen(Exception):
    pass


def test_every_training_row_is_a_reference_of_the_leaky_profile(spark, monkeypatch):
    rows = raw_lineitem(spark, LARGER)
    train = rows.filter(FQ.TRAIN)

    def seen(rows, stats, models):
        raise Seen(models.reference.count())

    monkeypatch.setattr(training, "score_matrix", seen)
    with pytest.raises(Seen) as found:
        training.leaky_metrics(train, rows.filter("split = 'validation'"), FQ.line_stats(spark, LARGER))
    assert found.value.args == (train.count(),)


def test_large_references_serve_batch_stream_and_crawl(spark, sf, monkeypatch):
    stats, models = FQ.page_stats(spark, sf), MQ.page_models(spark, sf)
    rows = FQ.raw_pages(spark, sf)
    carried = sorted(scoring.score_records(rows, stats, models).collect())
    monkeypatch.setattr(KN, "REFERENCE_BYTES", 0)
    assert not KN.is_carried(models.reference)
    whole = scoring.score_records(rows, stats, models)
    assert sorted(whole.collect()) == carried
    stream = PQ.QUERIES["score_stream"](spark, sf)
    assert sorted(stream.select(*whole.columns).collect()) == carried
    assert PQ.QUERIES["serve_crawl"](spark, sf).filter(F.col("knn_scratch_label").isNull()).count() == 0
