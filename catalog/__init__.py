"""Registered queries by area, each with the DuckDB statement that checks it."""

from catalog import fit_queries, model_queries, page_queries, plan_queries, profile_queries, record_queries, url_queries

AREAS = (url_queries, page_queries, fit_queries, model_queries, record_queries, profile_queries, plan_queries)
