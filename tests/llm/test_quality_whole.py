"""Training on whole documents."""

import numpy as np
import pytest

from urlsift.llm import quality


def long_text(seed, n=6000):
    rng = np.random.default_rng(seed)
    return " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 7)) for _ in range(n))


def test_every_bucket_of_a_long_text_is_kept():
    text = long_text(1)
    at, n = quality.bag(text)
    total = 0
    for codes, begin, end, _ in quality.packed([text], quality.ORDERS - 1):
        for found, valid in quality.features(codes, begin, end):
            total += np.bincount(found[valid], minlength=1 << quality.BITS)
    assert len(at) > 4096 and (at == np.flatnonzero(total)).all() and n.sum() == total.sum()


def test_buckets_of_no_document_add_nothing():
    known, other = long_text(2, 50), long_text(3, 50)
    model = quality.train([(*quality.bag(known), 1), (*quality.bag("plain words of another kind"), 0)])
    seen = {*quality.bag(known)[0], *quality.bag("plain words of another kind")[0]}
    free = np.setdiff1d(quality.bag(other)[0], list(seen))
    assert len(free) and not model.logit[free].any()


def test_bags_from_a_file_train_the_same_model():
    docs = [(k, k % 2, quality.bag(long_text(k, 30 + 200 * (k % 3)))) for k in range(12)]
    shuffled = [docs[k] for k in np.random.default_rng(4).permutation(len(docs))]
    bags = quality.Bags((i, y, np.concatenate(b).astype(np.int32).tobytes()) for i, y, b in shuffled)
    one, two = quality.train(bags), quality.train([(*b, y) for _, y, b in docs])
    bags.close()
    assert len(bags) == 12 and one.bias == two.bias and (one.logit == two.logit).all()


def test_words_far_behind_are_learned(spark):
    marks = ["zqxj wvkz", "yfgh pbmd"]
    rows = [(k, long_text(k, 3000) + f" {marks[k % 2]}" * 200) for k in range(16)]
    docs = spark.createDataFrame(rows, "id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(16)], "id long, label int")
    model = quality.fit_quality(docs, labels)
    taught = [quality.bag(m)[0] for m in marks]
    assert model.logit[taught[1]].all() and model.logit[taught[0]].all()
    assert np.mean(model.logit[taught[1]]) > np.mean(model.logit[taught[0]])
    assert model.scores([marks[1]])[0] > model.scores([marks[0]])[0]


def test_empty_bags_are_passed_over():
    assert quality.train([]).bias == 0
    assert quality.train([(*quality.bag(""), 1)]).scores(["x"])[0] == pytest.approx(0.5)


def test_rows_of_one_id_do_not_exceed_the_bound(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "train", lambda bags: seen.append([(len(bags[i][0]), bags[i][2]) for i in range(len(bags))]))
    rows = [(1, "many " * (k % 3) + f"text{k}") for k in range(400)] + [(k, "alone") for k in range(2, 8)]
    docs = spark.createDataFrame(rows, "id long, text string").repartition(4)
    labels = spark.createDataFrame([(k, int(k > 1)) for k in range(1, 8)], "id long, label int")
    quality.fit_quality(docs, labels, max_documents=20)
    assert len(seen[0]) == 20 and sum(y for _, y in seen[0]) == 6


def test_rows_that_repeat_an_id_and_its_text_count_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "train", lambda bags: seen.append([bags[i][2] for i in range(len(bags))]))
    docs = spark.createDataFrame([(1, "same text")] * 300 + [(1, "another"), (2, "same text")], "id long, text string").repartition(4)
    quality.fit_quality(docs, spark.createDataFrame([(1, 0), (2, 1), (2, 1)], "id long, label int"))
    assert sorted(seen[0]) == [0, 0, 1]
