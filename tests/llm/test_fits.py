"""The fits of the two classifiers against plain loops."""

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from urlsift.llm import language_id, quality

MASK = (1 << 64) - 1


def bucket(gram, bits):
    step, mix = int(language_id._STEP), int(language_id._MIX)
    h = 0
    for c in gram:
        h = (h * step + ord(c)) & MASK
    mixed = (h + len(gram)) * mix & MASK
    return ((mixed ^ mixed >> 32) * step & MASK) >> 64 - bits


def test_language_counts_by_a_plain_loop(spark):
    rows = [("Ab c", "x"), ("ab", "x"), ("ünï", "y"), ("", "y"), (None, "x"), ("lost", None), ("ab", "x")]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    model = language_id.fit_languages(df, F.col("text"), F.col("lang"), orders=3, bits=8, smoothing=0.5)
    counts, seen = {"x": Counter(), "y": Counter()}, Counter()
    for text, lang in rows:
        if text is None or lang is None:
            continue
        seen[lang] += 1
        padded = text.lower() + "\0\0"
        for i in range(len(text)):
            counts[lang].update(bucket(padded[i : i + n], 8) for n in (1, 2, 3))
    assert model.labels == ("x", "y")
    for j, lang in enumerate(model.labels):
        total = sum(counts[lang].values()) + 0.5 * 256
        want = [math.log((counts[lang][b] + 0.5) / total) for b in range(256)]
        assert np.allclose(model.table[j], want) and math.isclose(model.prior[j], math.log(seen[lang] / 5))


def test_quality_gradient_by_a_plain_loop():
    bags = [(np.array([3, 9]), np.array([2, 1]), 1), (np.array([9, 40]), np.array([1, 3]), 0), (np.array([7]), np.array([5]), 1)]
    model = quality.train(bags, epochs=2, rate=0.5, seed=4)
    rng, dims = np.random.default_rng(4), quality.DIMENSIONS
    start = rng.uniform(-1 / dims, 1 / dims, (1 << quality.BITS, dims))
    vectors = {b: start[b].tolist() for b in (3, 7, 9, 40)}
    output, bias = [[0.0] * dims, [0.0] * dims], [0.0, 0.0]
    for step in range(6):
        if step % 3 == 0:
            order = rng.permutation(3)
        at, counts, label = bags[order[step % 3]]
        speed, weight = 0.5 * (1 - step / 6), [c / counts.sum() for c in counts]
        mean = [sum(w * vectors[b][i] for w, b in zip(weight, at, strict=True)) for i in range(dims)]
        raw = [sum(o * m for o, m in zip(output[k], mean, strict=True)) + bias[k] for k in (0, 1)]
        p = [math.exp(r - max(raw)) for r in raw]
        error = [x / sum(p) - (k == label) for k, x in enumerate(p)]
        pull = [sum(output[k][i] * error[k] for k in (0, 1)) for i in range(dims)]
        for k in (0, 1):
            output[k] = [o - speed * error[k] * m for o, m in zip(output[k], mean, strict=True)]
            bias[k] -= 0.1 * speed * error[k]
        norm = math.sqrt(sum(w * w for w in weight))
        for w, b in zip(weight, at, strict=True):
            vectors[b] = [v - speed * w / norm * g for v, g in zip(vectors[b], pull, strict=True)]
    for b, v in vectors.items():
        assert math.isclose(model.logit[b], sum(x * (o1 - o0) for x, o0, o1 in zip(v, *output, strict=True)), rel_tol=1e-9, abs_tol=1e-12)
    assert math.isclose(model.bias, bias[1] - bias[0], rel_tol=1e-9) and not model.logit[[0, 1, 2]].any()
