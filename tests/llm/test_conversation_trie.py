"""The conversation trie against a plain dictionary of prefixes."""

import hashlib
import math
import random
import zlib

import pytest

from catalog.check import compare, connect
from urlsift import runtime
from urlsift.llm import conversation_trie as ct
from urlsift.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows, group=5, heads=9):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        whole = own.get(c - int(math.fmod(c, group)), [])[:h] + turns[h:]
        for d in range(len(whole) + 1):
            members.setdefault(tuple(whole[:d]), []).append(c)
        ends.setdefault(tuple(whole), []).append(c)
    out = []
    for p, cs in members.items():
        under = [q for q in members if q[: len(p)] == p]
        children = [q for q in under if len(q) == len(p) + 1]
        leaves = sum(not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in under) for q in under)
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in under if q)
        sha = hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(children), leaves, saved, sha))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=repr)


def table(seed, n, deepest, texts):
    rng = random.Random(seed)
    rows = [(c, t, rng.choice(["user", None]), rng.choice(texts)) for c in range(n) for t in range(rng.randint(0, deepest))]
    rng.shuffle(rows)
    return rows


MESSY = [
    (7, None, None, None), (7, None, "user", "é"), (7, 1, "", ""), (7, 1, "", ""), (7, 1, "a", "long " * 5000),
    (5, 0, "user", "first"), (5, 1, "user", "second"), (5, 1, "user", "second"), (6, 0, "user", "own"), (None, 0, "user", "nobody"),
    (9, 3, "user", "only one"), (2**40, 0, "user", "first"), (-3, 0, "user", "first"), (-5, 0, "user", "zero"),
]


@pytest.mark.parametrize("block", [1, 50])
def test_random_tables_split_to_the_end(spark, block):
    rows = table(block, 15, 6, ["", "a", "bb", "ünï"])
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(ct.prefix_trie(df, block=block)) == brute(rows)


def test_one_deep_conversation_and_many_copies(spark):
    rows = [(c, t, "user", "same") for c in range(40) for t in range(3)] + [(1000, t, "user", "same") for t in range(120)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(ct.prefix_trie(df, block=40, turns_held=4)) == brute(rows)


def test_messy_rows_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(MESSY, SCHEMA).withColumns({c: F.lit("x") for c in ("c", "d", "m", "up", "j", "len", "row", "x1", "under")})
    assert found(ct.prefix_trie(df)) == brute(MESSY)


def test_no_rows_and_no_numbers(spark):
    assert ct.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert ct.prefix_trie(spark.createDataFrame([(None, 0, "user", "x")], SCHEMA)).collect() == []


def test_every_id_is_hashed_across_pieces(spark, monkeypatch):
    monkeypatch.setattr(ct, "PIECE", 16)
    monkeypatch.setattr(ct, "ROWS_PER_RANGE", 10)
    rows = [(c, 0, "user", "same") for c in range(0, 400, 5)]
    assert found(ct.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_nothing_is_left_but_the_result(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runtime, "work_dir", lambda spark: str(tmp_path))
    ct.prefix_trie(spark.createDataFrame(table(3, 20, 6, ["a", "b"]), SCHEMA), block=20).collect()
    assert len(list(tmp_path.iterdir())) == 1


def test_query_equals_its_statement(spark, sf):
    assert compare(queries.op13_conversation_trie(spark, sf), connect(sf), queries.SQL["op13_conversation_trie"]) == ""
