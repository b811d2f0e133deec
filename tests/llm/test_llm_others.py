"""Search, audit, scans and the pipeline."""

import random
import re
from collections import Counter

import brute
import numpy as np
import pytest
from conftest import MESSY, SCHEMA
from pyspark.sql import functions as F

import corpus_pipeline
from urlsift.llm import fixity, language_id, licenses, queries, secrets, top_k


# Top-k


def vectors(n, width, spread, seed=1):
    rng = random.Random(seed)
    return [(i * 7 % 1009, [rng.randint(-spread, spread) for _ in range(width)]) for i in range(n)]


@pytest.mark.parametrize("n, width, spread, k", [(400, 6, 2, 20), (300, 16, 1 << 24, 5), (3, 4, 3, 20)])
def test_search_equals_brute_force(n, width, spread, k):
    rows = vectors(n, width, spread)
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    q = slice(0, 40)
    got_ids, got_scores, scored = top_k.search(ids[q], x[q], ids, x, k, block=16)
    want = brute.top_k(rows, set(ids[q].tolist()), k)
    for i, a, b in zip(ids[q].tolist(), got_ids, got_scores, strict=True):
        assert list(zip(a.tolist(), b.tolist(), strict=True)) == want[i]
    assert scored <= len(ids[q]) * -(-n // 16)


def test_search_prunes_coherent_blocks():
    x = np.zeros((1024, 8), np.int64)
    x[np.arange(1024), np.arange(1024) // 128] = 50 + np.arange(1024) % 7
    _, _, scored = top_k.search(np.array([-1]), x[:1], np.arange(1024), x, 10)
    assert scored == 1


def test_top_k_query(spark, folder):
    rng = random.Random(4)
    rows = [(i, [rng.randint(-3, 3) / 2 for _ in range(5)]) for i in range(200)]
    bad = [(20, None), (40, [1.0, None, 0.0, 0.0, 0.0]), (60, [float("nan")] * 5), (61, [float("inf")] * 5), (None, [1.0] * 5)]
    odd = {i for i, _ in bad}
    good = [(i, v) for i, v in rows if i not in odd] + [(300, []), (301, [2.0])]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<float>").withColumn("rank", F.lit(0)).withColumn("id", F.lit("x"))
    found = queries.op2_top_k(spark, folder(embeddings=df.repartition(3))).collect()
    want = brute.top_k([(i, [int(64 * x // 1) for x in v]) for i, v in good], {i for i, _ in good if i % 20 == 0}, 20)
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == want


def test_top_k_of_nothing(spark):
    none = spark.createDataFrame([], "id long, vector array<long>")
    one = spark.createDataFrame([(1, [1, 2]), (1, [1, 3]), (2, [5, 5]), (2, [5, 5])], "id long, vector array<long>")
    assert top_k.top_k(none, one).count() == top_k.top_k(one, none).count() == 0
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in top_k.top_k(one.filter("id = 1"), one, 5).collect())
    assert got == [(1, 1, 2, 15), (1, 2, 2, 15)]


# Fixity

RECORDS = "file string, offset long, length long, hash string"


def tree(spark, rows):
    return fixity.build(spark.createDataFrame(rows, RECORDS))


def test_audit_finds_what_differs(spark):
    rows = [(f"f{f}", k * 5000, 5000, f"h{f}-{k}") for f in range(3) for k in range(4000)]
    other = [r for r in rows if r[:2] != ("f1", 500_000)]
    other[7] = (*other[7][:3], "bad")
    other += [("f1", 4000 * 5000, 10, "new"), ("f9", 0, 3, "alone")]
    found = fixity.audit(tree(spark, rows), tree(spark, other)).collect()
    got = sorted((r.damage, r.file, r.offset, r.hash, r.found_hash) for r in found)
    assert got == [
        ("changed", "f0", 35_000, "h0-7", "bad"), ("extra", "f1", 20_000_000, None, "new"), ("extra", "f9", 0, None, "alone"),
        ("missing", "f1", 500_000, "h1-100", None),
    ]


def test_audit_of_equal_and_empty_replicas(spark):
    rows = [("f", 0, 3, "a"), ("f", 0, 3, "a"), ("f", 3, 0, "b"), ("f", 3, 1, "c")]
    same, none = tree(spark, rows), tree(spark, [])
    assert fixity.audit(same, tree(spark, rows[::-1])).count() == 0
    assert fixity.audit(none, none).count() == 0
    assert {r.damage for r in fixity.audit(same, none).collect()} == {"missing"}


def test_fixity_query_on_messy_pages(spark, folder):
    rows = [(k, f"http://x/{k}", "<p>ü</p>" * (k % 5)) for k in range(300)] + [(None, None, None), (7, None, "x" * 300_000), (7, "u", None), (7, "u", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("file", F.lit(1)).withColumn("hash", F.lit(2))
    found = queries.op4_fixity(spark, folder(pages=pages)).collect()
    import zlib

    damaged = Counter({5: "changed", 9: "missing"}.get(zlib.crc32(str(i).encode()) % 64) for i, _, _ in set(rows) if i is not None)
    assert Counter(r.damage for r in found) == Counter({k: v for k, v in damaged.items() if k})


# Licenses


def test_license_places(spark, folder):
    texts = [
        "Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.", None, "", "cc", "CC-by cc by",
        "all rights all rights reserved", "Copyright (c) 2020 Jane Doe. All rights reserved.", "x " * 200_000 + "general public license",
        "Licensed under the Apache License, 2.0", "licensed under the apache licence version 2.0", "Released under the MIT License.",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("labels", F.lit("z"))
    found = sorted(queries.op9_licenses(spark, folder(documents=df)).collect())
    phrases = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}
    for r, text in zip(found, texts, strict=True):
        w = brute.words(text)
        hits = [(i, label) for i in range(len(w)) for p, label in phrases.items() if tuple(w[i : i + len(p)]) == p]
        places = [i for i, _ in hits]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(hits), min(places, default=None), max(places, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in hits})) and set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    assert [r.labels for r in found] == [
        "cc-by,cc-by-nc-4.0", "gpl,gpl-3.0", "", "", "", "cc-by", "reserved", "copyright,reserved", "gpl", "apache-2.0", "", "mit",
    ]


def test_template_regions():
    notices, plain = licenses.compiled({"x": ("use of <<var;who;[a-z]+;1-2>> is <<beginOptional>>not<<endOptional>> allowed",)}, ())
    accepts = lambda text: bool(licenses.scan(text, notices, plain).notices)
    assert accepts("Use of it is allowed") and accepts("the use of that thing is not allowed.")
    assert not accepts("use of is allowed") and not accepts("use of one two three is allowed") and not accepts("use of it is never allowed")


# Secrets


def test_secret_spans(spark, folder):
    form = re.compile(
        r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"""
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    texts = [
        "token: abc password = 'hunter2hunter' API_KEY:abcdefg", "ſecret=abcdefgh toKen=abcdefgh", None, "", "AKIA" + "A1" * 8 + " AKIASHORT",
        "漢字 " + "ab12" * 6 + " " + "ab12" * 5, "secret: token: abcdefgh", "password=" + "e3b0c44298fc1c149afbf4c8" + "g", "x" * 500_000 + " passwd=123456",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("spans", F.lit(1))
    for r, text in zip(sorted(queries.op10_secrets(spark, folder(documents=df)).collect()), texts, strict=True):
        text = text or ""
        spans = [(m.start(), 0, m.end()) for m in form.finditer(text) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        base = [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans)]
        kinds = Counter(k for _, k, _ in spans)
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == (kinds[0], kinds[1], kinds[2], brute.sha(",".join(base)))
        assert set(base) <= set(r.spans.split(","))


def test_entropy_windows():
    rng = random.Random(2)
    for size in (20, 45):
        run = "".join(rng.choice("abcdef0123456789") for _ in range(size))
        want = []
        for a in range(size - 19):
            part = Counter(run[a : a + 20])
            if -sum(n / 20 * np.log2(n / 20) for n in part.values()) >= 3.2:
                want.append(a)
        covered = {i for a in want for i in range(a, a + 20)}
        got = {i for a, b in secrets.window_spans(run, 3.2) for i in range(a, b)}
        assert got == covered


def test_entropy_finds_keys_and_spares_the_allowed():
    key = "wJa1rXUtn9FEMI2K7MDENGbPxRfiCYzQ"
    assert secrets.entropy_spans(f"key {key} end") == [(4, 36, "entropy")]
    assert secrets.entropy_spans(f"key example{key} end") == []
    assert secrets.entropy_spans("123e4567-e89b-12d3-a456-426614174000 " + "internationalisation" * 2) == []


# Pipeline


def test_pipeline_equals_brute_force(spark, folder):
    rng = random.Random(8)
    common = "the of and to in that was for with this from have they which".split()
    names = [a + b for a in "ka lo mi ter san dor".split() for b in "ven ral pot sig mun".split()]
    text = lambda n: " ".join(rng.choice(common if rng.random() < 0.3 else names) for _ in range(n))
    passage, line = text(30), text(9)
    rows = [(i, f"{text(40)}\n{line}\n{text(rng.randint(5, 60))}", "en", f"s{i % 3}", 1) for i in range(1, 30)]
    rows += [(i, rows[i - 40][1], "en", "s1", 1) for i in range(40, 45)]
    rows += [(60, f"{text(20)} {passage}", "en", "s2", 1), (61, text(900) + " " + passage, "en", "s2", 1)]
    rows += [(None, text(50), "en", None, None) if r[0] is None else (r[0] + 100 * (r[0] != 10), *r[1:]) for r in MESSY]
    items = [(1, passage), (2, None), (3, "nowhere at all")]
    docs = spark.createDataFrame(rows, SCHEMA)
    path = folder(documents=docs, benchmark=spark.createDataFrame(items, "item_id long, text string"))

    model = language_id.fit_languages(docs, F.col("text"), F.col("lang"))
    labels, scores = model.predict([r[1] for r in rows])
    kept = [r for r, x, s in zip(rows, labels, scores, strict=True) if x != "und" and s >= 0.5]
    lines = brute.line_dedup([(r[0], r[1]) for r in kept])
    kept = [(r[0], x[2], r[3]) for r, x in zip(kept, lines, strict=True)]
    groups = {}
    for r, (_, _, c) in zip(kept, brute.components([(r[0], r[1]) for r in kept]), strict=True):
        groups.setdefault(c, []).append(r)
    kept = [min(g, key=lambda r: (r[0] is None, r[0])) for g in groups.values()]
    marks = brute.contamination([(r[0], r[1]) for r in kept], items)
    kept = [r for r, (n, hit, _) in zip(kept, marks, strict=True) if not (hit and 20 * hit >= n)]
    sizes = {}
    for _, t, s in kept:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    size, taken = brute.taken(kept, brute.targets(sizes))
    want = [(r[0], r[2], n, k) for r, n, k in zip(kept, size, taken, strict=True)]
    found = corpus_pipeline.run(spark, path).collect()
    assert sorted(((r.doc_id, r.source, r["size"]) for r in found), key=repr) == sorted((w[:3] for w in want), key=repr)
    assert sorted(((r.doc_id, r.taken) for r in found), key=repr) == sorted(((w[0], w[3]) for w in want), key=repr)
    assert {r.doc_id for r in found} >= set(range(1, 30)) | {61} and 60 not in {r.doc_id for r in found}


def test_stages_return_the_columns_of_documents(spark, sf, nothing, folder):
    assert len(corpus_pipeline.STAGES) == 5
    path = folder(documents=nothing, benchmark=spark.createDataFrame([], "item_id long, text string"))
    docs = nothing
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == nothing.columns and dict(docs.dtypes) == dict(nothing.dtypes)
    assert corpus_pipeline.run(spark, path).count() == 0
