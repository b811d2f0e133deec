"""Operators of a training-data pipeline: language, quality, duplicates, contamination, mixing, audits and scans."""
