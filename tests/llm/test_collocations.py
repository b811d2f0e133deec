"""Collocations against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalog.check import compare, connect
from urlsift.llm import collocations as co
from urlsift.llm import queries

NAMES = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, support, share=80, first=2000):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for size in range(1, 5):
                f.update((lang, tuple(w[i : i + size])) for i in range(len(w) - size + 1))
    out = []
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= support}
    longer = Counter()
    for (lang, q), b in candidates.items():
        for i in range(len(q)):
            for j in range(i + 2, len(q) + 1):
                if j - i < len(q):
                    longer[lang, q[i:j]] = max(longer[lang, q[i:j]], b)
    for (lang, p), a in candidates.items():
        cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        inside = 100 * longer[lang, p] >= share * a
        if not inside:
            out.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    ranked = []
    for lang in n:
        own = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))[:first]
        ranked += [(x[0], i + 1, *x[1:]) for i, x in enumerate(own)]
    return sorted(ranked)


def found(df):
    return sorted(tuple(r[n] for n in NAMES) for r in df.collect())


def texts(seed, n):
    rng = random.Random(seed)
    words = ["a", "B", "new", "York", "city", "ünï", "漢", "\x00", " "]
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!?", "\r\n", "\x85"]
    return [
        (rng.choice(["en", "de", None, "und"]), rng.choice([None, ""]) if rng.random() < 0.05 else "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(0, 60))))
        for _ in range(n)
    ]


@pytest.mark.parametrize(("parts", "support"), [(1, 5), (7, 12), (13, 30)])
def test_random_texts_in_any_number_of_shards(spark, parts, support):
    rows = texts(parts, 300)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(parts)
    assert found(co.collocations(df, support=support, shards=5)) == brute(rows, support)


def test_blocks_and_buffers_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(co, "BLOCK", 16)
    monkeypatch.setattr(co, "BUFFER", 100)
    batches = [["x", "one two three four five " * 40], ["x", "one two"]]
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["x", "x"]), pa.array([t.encode() for _, t in batches])], ["lang", "t"])
    sums = {n: Counter() for n in (1, 2, 3, 4)}
    for _, places, table in co._buffers([batch]):
        codes = np.array(table.values, np.uint64)[places]
        for at in range(0, len(codes), co.BLOCK):
            part = codes[at : at + co.BLOCK + 3]
            for n in sums:
                fp, inside = co.grams(part, n)
                sums[n].update(fp[: co.BLOCK][inside[: co.BLOCK]].tolist())
    assert [sum(sums[n].values()) for n in (1, 2, 3, 4)] == [202, 200, 198, 197]


def test_bounds_keep_what_can_reach_the_support(spark):
    # Shards of least 3, 3 and 2: a phrase that isn't frequent in them occurs at most 2, 2 and 1 times there.
    cells = spark.createDataFrame([(1, 9, 3), (2, 9, 3), (3, 9, 2), (4, 8, 8)], "cell long, lang_cell long, least long")
    level = spark.createDataFrame([(10, 1, 5), (11, 1, 4), (12, 1, 3), (12, 3, 3), (13, 4, 8), (10, 4, 9), (14, 2, 3), (14, 3, 2)], "fp long, cell long, n long")
    have = {(r.fp, r.lang_cell) for r in co._possible([level, level.limit(0)], cells, 8).collect()}
    # 5 + 2 + 1 and 3 + 2 + 3 reach 8; 4 + 2 + 1 and 2 + 3 + 2 don't.
    assert have == {(10, 9), (12, 9), (13, 8), (10, 8)}


def test_counted_phrases_travel_packed():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    windows = [(cell, rng.integers(0, 1 << 64, 500, np.uint64)[rng.integers(0, 500, 4_000)]) for cell in (3, -5, 3)]
    windows.append((-5, windows[1][1][:2_000]))
    chunks = [co._chunks(found, cell, 9, 7) for cell, found in windows]
    # A row for each bucket, and 8 bytes for each phrase at most; three longs before.
    assert all(c.num_rows == 7 for c in chunks)
    assert all(sum(len(v.as_py()) for name in ("fps", "ns") for v in c[name]) == 8 * len(np.unique(f)) for c, (_, f) in zip(chunks, windows, strict=True))
    table = pa.Table.from_batches(chunks)
    have = Counter()
    for bucket in range(7):
        for r in co._merged(table.filter(pa.compute.equal(table["bucket"], bucket))).to_pylist():
            have[r["cell"], r["fp"] >> 32, r["fp"] & 0xFFFFFFFF] = r["n"]
    want = Counter((cell, (int(fp) >> 32) % 7, int(fp) & 0xFFFFFFFF) for cell, found in windows for fp in found)
    assert have == {k: n for k, n in want.items() if n >= 9}


@pytest.mark.parametrize("distinct", [3, 1 << 16, (1 << 16) + 1])
def test_numbered_words_come_back(distinct):
    import pyarrow as pa

    rng = np.random.default_rng(distinct)
    hashes = (np.arange(distinct + 6) * 64_007).astype(np.uint32)
    # The last six hashes don't occur, and so aren't written.
    places = rng.permutation(np.concatenate([np.arange(distinct), np.zeros(50, int), np.full(20, 2)])).astype(np.int32)
    table, numbers = co._numbered(places, hashes)
    assert len(table) == 4 * distinct and len(numbers) == len(places) * (2 if distinct <= 1 << 16 else 4)
    assert np.frombuffer(table, np.uint32)[:2].tolist() == hashes[[0, 2]].tolist()
    codes = co._codes(pa.py_buffer(table), pa.py_buffer(numbers))
    assert (codes == co._spread(hashes)[places]).all() and ((codes == 0) == (places == 0)).all()


def test_arrays_take_two_bytes_a_word_and_four_for_each_distinct_one(spark, monkeypatch):
    sizes, dropped = [], co.drop_written
    monkeypatch.setattr(co, "drop_written", lambda df: (sizes.append({c: df.agg(F.sum(F.length(c))).first()[0] for c, kind in df.dtypes if kind == "binary"}), dropped(df))[1])
    rows = [("en", "one two three four. " * 5_000)] * 2
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    assert found(co.collocations(df)) == brute(rows, 30)
    # 40,000 words, 10,000 ends of pieces and two of texts; four words and the break.
    assert sum(sizes[-1].values()) == 2 * 50_002 + 4 * 5


def test_counted_phrases_pack_into_less_than_half():
    import pyarrow as pa

    found = np.random.default_rng(3).integers(0, 1 << 64, 200_000, np.uint64)
    rows = co._chunks(found, 1, 9, 64)
    data = b"".join(v.as_py() for pair in zip(rows["fps"], rows["ns"], strict=True) for v in pair)
    # Spark packs a shuffle by LZ4, in blocks of 32 KB.
    assert sum(pa.Codec("lz4_raw").compress(data[i : i + (1 << 15)]).size for i in range(0, len(data), 1 << 15)) < 3.6 * len(found)
    # Numbers of any size come back, also alone in their row.
    values, sizes = np.array([0, 1, 255, 256, 1 << 24, (1 << 32) - 1], np.uint32), np.array([1, 4, 1])
    assert co._unpacked(pa.chunked_array([co._rows(values, sizes)]), sizes).tolist() == values.tolist()


def test_rows_of_counted_phrases_stay_long_in_a_large_input():
    # 30 GB of documents have about 10 billion words; a row has three longs of its own, so it should hold many times that.
    buckets = 10_000_000_000 // co.BUCKET_WORDS
    found = np.random.default_rng(2).integers(0, 1 << 64, co.WINDOWS // 4, np.uint64)
    rows = co._chunks(found, 1, 9, buckets)
    assert rows.num_rows <= buckets and len(found) / rows.num_rows > 100


def test_only_phrases_in_doubt_are_counted_over_all_shards(spark):
    cells = spark.createDataFrame([(1, 9, 3), (2, 9, 3), (3, 9, 2)], "cell long, lang_cell long, least long")
    level = spark.createDataFrame([(10, 1, 5), (12, 1, 3), (12, 3, 4), (15, 2, 8)], "fp long, cell long, n long")
    have = {r.fp: r.known for r in co._possible([level], cells, 8).collect()}
    # 15 has 8 in one shard alone; 10 and 12 have 5 and 7, and may have more in shards where they aren't frequent.
    assert have == {10: 5, 12: 7, 15: 8}


def test_arrays_are_gone_before_the_phrases_are_counted(spark, monkeypatch):
    from urlsift import runtime

    left, names, phrases = [], [], co._phrases
    monkeypatch.setattr(co, "drop_written", lambda df: (left.append(df), runtime.drop_written(df)))
    monkeypatch.setattr(co, "_phrases", lambda *a: (names.append(len(left)), phrases(*a))[1])
    rows = texts(5, 100)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    assert found(co.collocations(df, support=5)) == brute(rows, 5)
    # The arrays and the four lengths' local counts.
    assert names == [co.LONGEST + 1]


def test_a_phrase_of_one_shard_alone_and_one_of_all_shards(spark):
    # 30 occurrences in one task, and three in each of ten.
    rows = [("en", "only here. " * 30 + "spread out. " * 3)] + [("en", "spread out. other words. " * 3)] * 9
    df = spark.createDataFrame(rows, "lang string, text string").repartition(10)
    assert found(co.collocations(df, support=30)) == brute(rows, 30)


def test_hashes_that_meet_do_no_harm(spark, monkeypatch):
    class Poor(co._Hashes):
        def __missing__(self, word):
            self[word] = at = len(self.values)
            self.values.append(1 + sum(word) % 7)
            return at

    rows = texts(3, 200)
    want = brute(rows, 10)
    bits = np.full(co.BITS // 8, 255, np.uint8)
    monkeypatch.setattr(co, "_Hashes", Poor)
    df = spark.createDataFrame(rows, "lang string, text string").select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("t"))
    phrases = co._phrases(df, bits, 10)
    have = {(r.lang, r.phrase): r.f for r in phrases.collect()}
    assert all(have[lang, phrase] == a for lang, _, phrase, a, *_ in want)


def test_messy_rows(spark, messy):
    rows = [(r.lang, r.text) for r in messy.select("lang", "text").collect()]
    assert found(co.collocations(messy, support=2)) == brute(rows, 2)


def test_nothing(spark, nothing):
    assert co.collocations(nothing).collect() == []


def test_first_rows_and_ties(spark):
    rows = [("en", "a b. c d. e f. z z z. ") for _ in range(6)]
    df = spark.createDataFrame(rows, "lang string, text string")
    assert found(co.collocations(df, support=5, first=2)) == brute(rows, 5, first=2)


def test_query_equals_its_statement(spark, sf):
    assert compare(queries.op12_collocations(spark, sf), connect("/root/testdata/sf0.001"), queries.SQL["op12_collocations"]) == ""
