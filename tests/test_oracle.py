"""A cross-section of the registered queries next to their DuckDB statements."""

import pytest

import __spark_entry__ as entry
from catalog.check import compare, connect

NAMES = (
    "url_features_all", "url_char_prob", "title_match", "page_features_all", "refs_all", "transform_pages",
    "cascade_modes_pages", "nb_score", "average_precision", "agreement", "redirects", "rate_limit", "outliers",
)


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_statement(spark, sf, con, name):
    assert compare(entry.queries()[name](spark, sf), con, entry.oracle_sql()[name]) == ""


def test_statements_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
