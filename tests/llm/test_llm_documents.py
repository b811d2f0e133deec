"""Document operators against brute force, on messy rows and on whole tables."""

import brute
import pytest
from conftest import LINE, MESSY
from pyspark.sql import functions as F

from urlsift.llm import decontaminate, language_id, line_dedup, mixing, quality, queries, simhash
from urlsift.llm.common import packed


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_packed_gives_every_position_once():
    texts = ["", "abc", "x" * 1000, "yz"]
    seen = [""] * len(texts)
    for codes, begin, end, owner in packed(texts, 2, size=64):
        for b, e, o in zip(begin, end, owner, strict=True):
            seen[o] += "".join(map(chr, codes[b:e]))
            assert e + 2 <= len(codes)
    assert seen == texts


# Language


def test_language_held_out_accuracy(spark, sf, documents):
    found = queries.op1_language_id(spark, sf).join(documents.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(found) > 40 and sum(r.lang == r.lang_pred for r in found) >= 0.97 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_language_of_messy_rows(spark, messy):
    model = language_id.fit_languages(messy, F.col("text"), F.col("lang"))
    assert model.labels == ("de", "en", "fr")
    found = messy.select("doc_id", "text", language_id.language(spark, model, F.col("text")).alias("p")).collect()
    assert len(found) == len(MESSY)
    for r in found:
        undetermined = not any(map(str.isalpha, r.text or ""))
        assert (r.p.lang_pred == "und") == undetermined and (r.p.score == 0) == undetermined


def test_language_scores_equal_plain_sums():
    import numpy as np

    table = np.log(np.random.default_rng(1).uniform(0.1, 1, (2, 1 << 8)))
    model = language_id.LanguageModel(("a", "b"), np.zeros(2), table, 3, 8)
    texts = ["hello world", "", "x", "y" * 300_000 + "z"]
    for text, row in zip(texts, model.scores(texts), strict=True):
        codes = np.array([ord(c) for c in text.lower()] + [0, 0], np.uint32)
        want = sum(table[:, b].sum(axis=1) for b in language_id.buckets(codes, 3, 8)) if text else np.zeros(2)
        assert np.allclose(row, want)


def test_language_of_nothing(spark, nothing, messy):
    model = language_id.fit_languages(nothing, F.col("text"), F.col("lang"))
    found = messy.select(language_id.language(spark, model, F.col("text")).alias("p")).collect()
    assert {r.p.lang_pred for r in found} == {"und"}
    assert nothing.select(language_id.language(spark, model, F.col("text"))).count() == 0


# Contamination

ITEMS = [
    (1, "a b a b a b c"), (2, "b c"), (3, "a b c d e f g h i j k l m n o p"), (4, ""), (5, None), (None, "k l m"), (7, "!!"), (2, "b c"),
    (8, "A"), (9, "zz top"),
]
TEXTS = [
    (1, "A b, a B; a b c x b c"), (2, "a b c d e f g h i j k l m n"), (3, "x c d e f g h i j k l m n o p y"), (3, "b c"), (3, "b c"),
    (4, None), (5, ""), (None, "k l m k"), (6, "b a " * 3000 + "b c"), (7, "c d e f g h i j k l m n"), (8, "Ü zz ü TOP zz top"),
]


@pytest.mark.parametrize("window", [3, 13])
def test_contamination(spark, window):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string").withColumn("term", F.lit(1))
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("word", F.lit("a"))
    found = decontaminate.contamination(docs, items, window=window)
    got = rows_of(found, "id", "n_words", "n_hit", "item_ids")
    named = [(i, t) for i, t in ITEMS if i is not None]
    listed = [x[2] for x in brute.contamination(TEXTS, named, window)]
    every = brute.contamination(TEXTS, ITEMS, window)
    want = [(i, n, hit, ids) for (i, _), (n, hit, _), ids in zip(TEXTS, every, listed, strict=True)]
    assert got == sorted(want, key=repr)


def test_contamination_of_random_words(spark):
    import random

    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice("a b c d".split()) for _ in range(n))
    docs, items = [(i, text(rng.randint(0, 60))) for i in range(60)], [(i, text(rng.randint(1, 8))) for i in range(12)]
    found = decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), window=5
    )
    want = [(i, *x) for (i, _), x in zip(docs, brute.contamination(docs, items, 5), strict=True)]
    assert rows_of(found, "id", "n_words", "n_hit", "item_ids") == sorted(want, key=repr)


def test_contamination_of_nothing(spark, nothing, messy):
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(nothing, items).count() == 0
    assert {(r.n_hit, r.n_items) for r in decontaminate.contamination(messy, items).collect()} == {(0, 0)}


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "p q one two so three four q"), (2, "one x x x x two three four"), (3, "nothing")], "doc_id long, text string")
    terms = decontaminate.item_terms(spark.createDataFrame([(1, "one two three four")], "item_id long, text string"))
    index = decontaminate.build_index(decontaminate._documents(docs, "doc_id", "text"), terms.select("word", "term").distinct())
    assert decontaminate.phrase_matches(index, terms, 4).count() == 0
    found = decontaminate.proximity_matches(index, terms, 4, play=1, share=1.0).collect()
    assert {(r.id, r.item_id, r.near) for r in found} == {(1, 1, 4)}


# Line dedup


@pytest.mark.parametrize("batches", [1, 4])
def test_line_dedup(messy, batches):
    found = line_dedup.dedup_lines(messy, batches=batches).select("doc.doc_id", "doc.key", "n_lines", "n_dropped", "kept")
    docs = [(x[0], x[1]) for x in MESSY]
    want = [(i, "key", *x) for (i, _), x in zip(docs, brute.line_dedup(docs), strict=True)]
    assert rows_of(found, "doc_id", "key", "n_lines", "n_dropped", "kept") == sorted(want, key=repr)


def test_line_dedup_of_nothing(nothing):
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_runs_are_merged_and_keep_their_keys(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    for k in range(5):
        keys = spark.range(k * 5, k * 5 + 10).select(F.col("id").alias("h1"), (-F.col("id")).alias("h2"), F.lit(k).cast("long").alias("owner"))
        fresh = runs.files(runs.take(keys))
        assert fresh.count() == (10 if k == 0 else 5)
        runs.compact()
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    held = [spark.table(n) for level in runs.levels for n in level]
    assert sorted(r.h1 for t in held for r in t.collect()) == list(range(30))
    runs.clear()


# SimHash


def test_near_duplicates(messy):
    found = simhash.near_duplicates(messy).select("id", F.expr("conv(hex(fp), 16, 10)").alias("fp"), "component")
    docs = [(x[0], x[1]) for x in MESSY]
    want = [(i, str(fp), c) for (i, _), (fp, c, _) in zip(docs, brute.components(docs), strict=True)]
    assert rows_of(found, "id", "fp", "component") == sorted(want, key=repr)


def test_near_duplicates_of_nothing(nothing):
    assert simhash.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("distance, segments", [(3, 2), (3, 3), (2, 4), (0, 1)])
def test_links_are_complete(spark, distance, segments):
    import random

    rng = random.Random(distance)
    prints = {rng.getrandbits(64) for _ in range(30)}
    for fp in list(prints):
        for flips in range(1, 6):
            prints.add(fp ^ sum(1 << b for b in rng.sample(range(64), flips)))
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= distance}
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), distance, segments).collect()
    assert {(r.a, r.b) for r in found} == want and len(found) == len(want)


def test_fingerprint_does_not_depend_on_blocks(monkeypatch):
    import urlsift.llm.simhash as module
    from urlsift.llm import common

    text = "Some words that are\tspread over\n\nseveral blocks of the text " * 9
    monkeypatch.setattr(module, "word_blocks", lambda data: common.word_blocks(data, 7))
    assert module.text_fingerprint(text) == brute.fingerprint(text)


# Mixing


def test_mix(messy):
    found = mixing.mix(messy, block=64).taken()
    docs = [(x[0], x[1], x[3]) for x in MESSY]
    sizes = {}
    for _, t, s in docs:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    target = brute.targets(sizes)
    size, taken = brute.taken(docs, target)
    want = [(i, s, n, sizes[s], k) for (i, _, s), n, k in zip(docs, size, taken, strict=True)]
    assert rows_of(found, "id", "source", "size", "source_size", "taken") == sorted(want, key=repr)
    for r in found.collect():
        assert r.target == pytest.approx(target[r.source]) and r.taken <= 3 * r["size"]


def test_schedule_follows_the_weights_from_the_start(documents):
    plan = mixing.mix(documents, block=16)
    share = {r.s: r.slots for r in plan.sources.collect()}
    drawn = [r.s for r in plan.schedule.filter("slot is not null").orderBy("slot").collect()]
    n = len(drawn)
    for stop in (n // 10, n // 2, n):
        for s, slots in share.items():
            assert abs(drawn[:stop].count(s) - stop * slots / sum(share.values())) < 12


def test_mix_reruns_agree_and_nothing_is_nothing(documents, nothing):
    runs = [rows_of(mixing.mix(documents.repartition(n)).taken(), "id", "size", "target", "taken") for n in (2, 5)]
    assert runs[0] == runs[1]
    assert mixing.mix(nothing).taken().count() == 0


def test_targets_are_reshared(spark):
    sizes = {"a": 10, "b": 1000, "c": 0, "d": 500, None: 3}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    assert got == pytest.approx(brute.targets(sizes))


# Quality


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = queries.op7_quality(spark, sf).filter("held_out").join(labels, "doc_id").collect()
    assert len(found) > 50 and sum(r.predicted == r.quality for r in found) >= 0.95 * len(found)


def test_quality_of_messy_rows(spark, messy, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (6, 0), (None, 1), (10, None), (4, 1), (3, 1)], "doc_id long, quality int")
    model = quality.fit_quality(messy.select("doc_id", "text"), labels)
    found = messy.select("text", quality.quality(spark, model, F.col("text")).alias("score")).collect()
    assert all(0 <= r.score <= 1 for r in found)
    empty = {r.score for r in found if not r.text}
    assert len(empty) == 1
    blank = quality.fit_quality(nothing.select("doc_id", "text"), labels)
    assert {r.p for r in messy.select(quality.quality(spark, blank, F.col("text")).alias("p")).collect()} == {0.5}


def test_quality_average_equals_its_bag():
    import numpy as np

    rng = np.random.default_rng(3)
    model = quality.QualityModel(rng.normal(size=1 << quality.BITS), 0.1)
    texts = ["One two, THREE two!!", "a", "x y", LINE, "  "]
    for text, got in zip(texts, model.scores(texts), strict=True):
        at, n = quality.bag(text)
        logit = 0.1 + (float(model.logit[at] @ n / n.sum()) if len(at) else 0)
        assert got == pytest.approx(1 / (1 + np.exp(-logit)))
