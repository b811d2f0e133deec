"""Whole documents through the CSV sink and source."""

import __spark_entry__ as entry
from catalog.check import compare, connect
from urlsift.sources import files


def test_whole_documents_equal_their_statement(spark, sf):
    found = entry.queries()["csv_whole_texts"](spark, sf)
    assert compare(found, connect(sf), entry.oracle_sql()["csv_whole_texts"]) == ""
    longest = max(len(r.text) for r in entry.queries()["csv_whole_texts"](spark, sf).collect())
    assert longest > 300 + len('He said "", ok\nen')


def test_marks_far_behind_in_long_values(spark, tmp_path):
    tail = 'a, "b"\n""\r\n\\"c\\\n,'
    rows = [(1, "x" * 400 + tail), (2, ('line "q", z\n' * 200_000) + tail), (3, "word " * 500_000 + tail + "end")]
    files.write_csv(spark.createDataFrame(rows, "id long, t string"), str(tmp_path / "csv"))
    back = files.read_csv(spark, str(tmp_path / "csv"), "id long, t string").collect()
    assert sorted((r.id, r.t) for r in back) == rows
