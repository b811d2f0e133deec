"""Cases at the edge: missing values, equal keys, late rows, broken input, long lists."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from urlsift import contract as C
from urlsift.functions import hosts as H
from urlsift.operators import evaluate as E
from urlsift.operators import knn as KN
from urlsift.operators import profile as PF
from urlsift.operators import naive_bayes as NB
from urlsift.operators.admission import admission_reason
from urlsift.operators.elements import scan_html
from urlsift.operators.ordering import positions
from urlsift.operators.quantiles import exact_quantiles
from urlsift.sources import files
from urlsift.streaming import rate_limit as RL


@pytest.mark.parametrize("descending", [False, True])
def test_positions_keep_missing_and_odd_values(spark, descending):
    values = [None if i % 5 == 0 else float("nan") if i % 7 == 0 else float("inf") if i % 11 == 0 else float(i % 4) for i in range(300)]
    df = spark.createDataFrame(list(enumerate(values)), "id long, v double")
    one, many = ({r.id: r.position for r in positions(df, "v", tie=["id"], descending=descending, rows_per_range=n).collect()} for n in (1000, 20))
    assert one == many and sorted(one.values()) == list(range(1, 301))


def test_average_precision_with_missing_scores(spark):
    rows = [(i, i % 3 % 2, None if i % 4 == 0 else (i * 7 % 50) / 50) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, y int, s double")
    one, many = (E.average_precision(df, "y", "s", ["id"], rows_per_range=n).first()[0] for n in (1000, 30))
    assert one == pytest.approx(many)


def test_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(float(i), None) for i in range(50)], "a double, b double")
    for options in ({}, {"small_cells": 0, "inside_rows": 5}):
        assert exact_quantiles(df, ["a", "b"], [0.5], **options) == {"a": [24.5], "b": [None]}


def test_every_query_row_is_answered_whatever_its_key(spark):
    refs = spark.createDataFrame([(i, 0, [float(i), 0.0]) for i in range(200)], "id long, label int, features array<float>")
    asks = spark.createDataFrame([(1, [0.0, 0.0]), (1, [50.0, 0.0]), (1, [50.0, 0.0]), (None, [199.0, 0.0])], "k long, features array<float>")
    answers = []
    for options in ({}, {"bound": 0, "block_rows": 64}):
        found = KN.nearest(asks, refs, keys=["k"], k=1, **options).collect()
        answers.append(sorted((str(r.k), r.neighbours[0].ref_id) for r in found))
    assert answers[0] == answers[1] == [("1", 0), ("1", 50), ("1", 50), ("None", 199)]


def _sequential(rows, limit, window):
    state, out = {}, {}
    for s, r, t in sorted(rows, key=lambda x: (x[2], x[1])):
        start, used = state.get(s, (None, 0))
        if start is None or (t - start).total_seconds() > window:
            start, used = t, 0
        out[r], state[s] = used < limit, (start, used + 1)
    return out


def test_rate_limit_of_batch_and_stream(spark, tmp_path):
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = [(rng.choice(["a", "b", "hot", "hot", "hot"]), i, start + dt.timedelta(seconds=rng.choice([1, 40]) * rng.randint(0, 900))) for i in range(600)]
    rows.sort(key=lambda x: (x[2], x[1]))
    schema = "s string, r long, t timestamp"
    df = spark.createDataFrame(rows, schema)
    want = _sequential(rows, 3, 60)
    got = RL.grant_batch(df.repartition(5), session="s", request="r", at="t", limit=3, window_seconds=60).collect()
    assert {x.request: x.granted for x in got} == want and {x.session for x in got} == {"a", "b", "hot"}
    # in time order over micro-batches, then a late batch: one row for each request
    for k in range(3):
        spark.createDataFrame(rows[k * 200 : k * 200 + 200], schema).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    late = [("a", 9000 + i, start - dt.timedelta(days=9)) for i in range(5)]
    spark.createDataFrame(late, schema).coalesce(1).write.parquet(str(tmp_path / "in/3"))
    out = str(tmp_path / "out")
    for stop in range(4):
        source = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(*[str(tmp_path / f"in/[0-{stop}]")])
        stream = RL.grant_stream(source, session="s", request="r", at="t", limit=3, window_seconds=60)
        run = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).format("parquet").start(out)
        assert run.awaitTermination(120)
    seen = {x.request: x.granted for x in spark.read.parquet(out).collect()}
    assert {k: v for k, v in seen.items() if k < 9000} == want
    assert {k for k in seen if k >= 9000} == {x[1] for x in late}


def test_broken_declarations_do_not_end_a_page():
    found = scan_html("<a href=x>..</a><![foo[bar]]><img><![if !IE]><img><!x><p>end")
    assert [e["tag"] for e in found["elements"]].count("img") == 2 and found["text"].endswith("end")


def test_standard_csv(spark, tmp_path):
    rows = [(1, 'He said "hi", ok'), (2, "two\nlines"), (3, None), (4, 'a\\"b')]
    files.write_csv(spark.createDataFrame(rows, "id long, t string"), str(tmp_path / "csv"))
    back = files.read_csv(spark, str(tmp_path / "csv"), "id long, t string").collect()
    assert sorted(tuple(r) for r in back) == rows


def test_unexpected_labels_are_counted_and_listed(spark):
    df = spark.createDataFrame([(i % 60,) for i in range(120)], "label int")
    with pytest.raises(C.ContractError, match=r"116 row\(s\) .* 58 label\(s\) from 2 to 59"):
        C.check_labels(df)
    assert [r.label for r in C.unexpected_labels(df).collect()] == list(range(2, 60))


def test_copies_of_rows(spark):
    rows = [(1, "a", None), (1, None, "a"), (None, "a", None), (1, "a", None), (2, "", "b"), (2, None, "b"), (None, None, None), (None, None, None), (None, None, None)]
    df = spark.createDataFrame(rows, "row long, h1 string, n string")
    assert tuple(PF.duplicate_count(df).first()) == (9, 6, 3)
    assert sorted((tuple(r) for r in PF.deduplicated(df).collect()), key=repr) == sorted(set(rows), key=repr)
    assert tuple(PF.duplicate_count(df.limit(0)).first()) == (0, 0, 0) and PF.deduplicated(df.limit(0)).collect() == []


def test_a_model_needs_class_zero(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0)], "label int, x double")
    with pytest.raises(ValueError, match="class 0"):
        NB.fit_naive_bayes(df, ["x"])


def test_hosts(spark):
    rules = ("com", "co.uk", "uk", "*.ck", "!www.ck", *[f"r{i}" for i in range(30_000)])
    cases = {
        "www.foo.co.uk": "foo.co.uk", "foo.com.": "foo.com", "com": None, "a.b.ck": "a.b.ck", "x.www.ck": "www.ck", "b.ck": None,
        "9.9.9.9": "9.9.9.9", "999.1.1.1": None, "::1": "::1", "a.r29999": "a.r29999", "nosuffix": None, "q.unknown": None,
    }
    df = spark.createDataFrame([(h,) for h in cases], "h string")
    got = {r.h: r.d for r in df.select("h", H.registrable_domain(F.col("h"), rules).alias("d")).collect()}
    assert got == cases


def test_suffix_rules_from_a_file(spark, tmp_path):
    (tmp_path / "rules.txt").write_text("// comment\n\ncom\n  co.uk  note\n*.ck\n!www.ck\nрф\n", encoding="utf-8")
    rules = files.read_suffix_rules(spark, str(tmp_path / "rules.txt"))
    assert set(rules) == {"com", "co.uk", "*.ck", "!www.ck", "xn--p1ai"}


def test_unicode_hosts(spark):
    urls = {
        "http://bücher.test/": "host_denied", "http://xn--bcher-kva.test/": "host_denied", "http://a.bücher.test/": "host_denied",
        "http://ok.example.org/": None, "http://ü" + "x" * 70 + ".org/": "invalid_hostname", "http://ü..org/": "invalid_hostname",
    }
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = {r.u: r.why for r in df.select("u", admission_reason(F.col("u"), ["xn--bcher-kva.test"]).alias("why")).collect()}
    assert got == urls
