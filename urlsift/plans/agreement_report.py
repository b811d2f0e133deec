"""The extraction gate: read stored pages, extract, compare with recorded values, choose
the reference scope, and list the features to demote."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsift import contract as C
from urlsift.operators import agreement as G
from urlsift.operators.page_features import page_features
from urlsift.runtime import written

BINARY = tuple(c for c in C.PAGE_FEATURES if c in C.BINARY)
COUNTS = tuple(c for c in C.PAGE_FEATURES if c not in C.BINARY)


def gate(expected: DataFrame, pages: DataFrame, scope: str = "anchor") -> DataFrame:
    """Score every page feature. ``expected`` has sha1, final_url, label and the recorded
    features, ``pages`` has sha1 and html; rows without a page drop out."""
    read = expected.select("sha1", "final_url").join(pages.select("sha1", "html"), "sha1")
    actual = page_features(read, keys=("sha1",), url="final_url", scope=scope)
    paired = written(G.pair_up(expected, actual, ["sha1"], C.PAGE_FEATURES, ["label"]), "paired")
    return G.split_report(paired, BINARY, COUNTS).withColumn("scope", F.lit(scope))


REFERENCES = ("NoOfSelfRef", "NoOfEmptyRef", "NoOfExternalRef")


def gate_both(expected: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reports of both reference scopes and the table that names the kept one. The scopes differ in the reference counts
    alone, so every page is read once for both."""
    first, other = "anchor", "all_resources"
    read = expected.select("sha1", "final_url").join(pages.select("sha1", "html"), "sha1")
    actual = page_features(read, keys=("sha1",), url="final_url", scope=first, also=(other,))
    twice = expected.withColumns({f"{c}_{other}": F.col(c) for c in REFERENCES})
    features = [*C.PAGE_FEATURES, *[f"{c}_{other}" for c in REFERENCES]]
    paired = written(G.pair_up(twice, actual, ["sha1"], features, ["label"]), "paired")
    turned = paired.withColumns({f"{c}_actual": F.col(f"{c}_{other}_actual") for c in REFERENCES})
    both = [G.split_report(rows, BINARY, COUNTS).withColumn("scope", F.lit(s)) for s, rows in ((first, paired), (other, turned))]
    reports = written(both[0].unionByName(both[1]), "reports")
    return reports, G.choose_scope(reports.select("scope", "feature", "value"))
