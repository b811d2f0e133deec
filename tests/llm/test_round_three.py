"""Versions of licenses, many secrets in one text, ids that are texts, and tables left behind."""

import time

import brute
import pytest
from pyspark.sql import functions as F

from urlsift import runtime
from urlsift.llm import decontaminate, fixity, licenses, line_dedup, secrets


@pytest.mark.parametrize(("text", "label"), [
    *[(f"Licensed under a CC BY{kind} {version} license.", f"cc-by{kind.lower()}-{version}")
      for kind in ("", "-SA", "-NC-ND") for version in ("1.0", "2.0", "2.5", "3.0", "4.0")],
    ("licensed under CC BY 7.1", "cc-by"),
    ("Subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2.0"),
    ("licensed under the Mozilla Public License Version 1.1", "mpl-1.1"),
    ("licensed under the GNU Lesser General Public License, version 2.1 or any later version", "lgpl-2.1"),
    ("licensed under the GNU Library General Public License version 2", "lgpl-2.0"),
])
def test_versions_have_labels_of_their_own(text, label):
    found = {x[0] for x in licenses.scan(text, *licenses.compiled()).notices}
    assert label in found
    assert {x for x in found if any(c.isdigit() for c in x)} <= {label}


def test_a_text_full_of_secrets_is_read_in_linear_time():
    def took(n):
        text = "".join(f'password="{k:08d}abcdefgh" AKIA{k:016d}ABCD x{k:05x}QZr8Lm3Kd9Tb2Wn5Yc7Hf4Js6Gp1\n' for k in range(n))
        start = time.perf_counter()
        known = secrets.known_spans(text)
        found = secrets.entropy_spans(text, known)
        return time.perf_counter() - start, len(text), len(known), found, known

    took(100)
    _, _, _, found, known = took(300)
    inside = [(a, b) for a, b, _ in found if any(x <= a and b <= y for x, y, _ in known)]
    assert found and not inside
    small, size, *_ = took(6_000)
    large, _, n, *_ = took(24_000)
    assert n >= 48_000 and size > 500_000 and large < 10 * small + 1


def test_line_dedup_of_text_ids(spark):
    rows = [(str(i), f"a line that many have\nown line of {i}") for i in range(40)] + [(None, "a line that many have")]
    df = spark.createDataFrame(rows, "doc_id string, text string").repartition(4)
    found = {(r.doc.doc_id, r.n_lines, r.n_dropped, r.kept) for r in line_dedup.dedup_lines(df).collect()}
    assert found == {(i, *rest) for (i, _), rest in zip(rows, brute.line_dedup(rows), strict=True)}


def test_contamination_of_equal_ids_and_none(spark):
    docs = [(None, "one two three four"), (0, "one two three four"), (0, "five"), (0, "five"), (7, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(1, "two three")], "item_id long, text string")
    got = sorted(((r.id, r.n_words, r.n_hit) for r in decontaminate.contamination(df, items).collect()), key=repr)
    assert got == sorted([(None, 4, 2), (0, 4, 2), (0, 1, 0), (0, 1, 0), (7, 0, 0)], key=repr)


def test_runs_leave_their_result_alone(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runtime, "work_dir", lambda spark: str(tmp_path))
    monkeypatch.setattr(fixity, "work_dir", lambda spark: str(tmp_path))
    items = spark.createDataFrame([(1, "two three")], "item_id long, text string")
    decontaminate.contamination(spark.createDataFrame([(1, "one two three")], "doc_id long, text string"), items, near=True).collect()
    assert len(list(tmp_path.iterdir())) == 1
    records = spark.range(50).select(F.col("id").alias("number"), F.lit(9).cast("long").alias("length"), F.sha2(F.col("id").cast("string"), 256).alias("hash"))
    a, b = fixity.build(fixity.laid_out(records, ["hash"])), fixity.build(fixity.laid_out(records.filter("number <> 7"), ["hash"]))
    assert fixity.audit(a, b).count() == 43
    assert not [p.name for p in tmp_path.iterdir() if p.name.startswith("branches")]


def test_stages_keep_columns_whose_names_they_might_use(spark, messy, folder):
    import corpus_pipeline

    path = folder(documents=messy, benchmark=spark.createDataFrame([(1, "the quick brown fox")], "item_id long, text string"))
    docs = messy
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == messy.columns and all(r._p == "_p" and r.of_id == "of_id" and r.copy == "copy" for r in docs.collect())
