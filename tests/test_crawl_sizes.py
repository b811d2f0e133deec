"""Sizes of crawled pages beyond 32 bits."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry


@pytest.mark.parametrize("name", ["crawl_outcome", "fetch_state", "outcome_counts"])
def test_long_pages(spark, tmp_path, name):
    rows = [(7, "http://a.test/"), (8, "http://b.test/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("html", F.repeat(F.lit("<p>x"), 10_000))
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    found = {tuple(r) for r in entry.queries()[name](spark, str(tmp_path)).collect()}
    # page 7: 200 after one hop, text/html, 40,000 x 100,000; page 8: a redirect without a target
    want = {
        "crawl_outcome": {(7, "too_large"), (8, "http_error")},
        "fetch_state": {(7, "unreachable"), (8, "unreachable")},
        "outcome_counts": {("too_large", 1), ("http_error", 1)},
    }
    assert found == want[name]
