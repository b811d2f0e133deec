"""From crawl attempts to verdicts: records, provenance, coverage, scores, consensus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsift import constants as K
from urlsift.operators import records as R
from urlsift.operators.fit import FittedStats
from urlsift.plans.scoring import MODELS, Models, score_records

FAMILIES = {
    family: tuple(f"{m}_label" for m, (f, _) in MODELS.items() if f == family)
    for family in dict.fromkeys(f for f, _ in MODELS.values())
}


def classify_crawl(crawl: DataFrame, stats: FittedStats, models: Models, *, key: str = "page_id",
                   minimum: float = K.COVERAGE_MIN, **record_options) -> DataFrame:
    """One row per attempt: labels, scores, coverage, abstention, consensus, verdict.

    Coverage is computed on the record's own row and travels with it through the
    transform and the models, so a page is read once and nothing is joined back.
    """
    records = R.build_records(crawl, key=key, demoted=stats.demoted, **record_options)
    found = R.provenance_columns(stats.demoted)
    names = F.array(*[F.lit(c) for c in found])
    sources = F.map_from_arrays(names, F.array(*found.values()))
    marked = records.withColumn("_sources", sources)
    covered = R.abstain(marked.withColumns(R.coverage_columns(F.col("_sources"))), minimum).drop("_sources")
    kept = ["scraped", "obtainable", "coverage", "abstained", "abstain_reason"]
    scored = score_records(covered.withColumnRenamed(key, stats.spec.keys[0]), stats, models, kept)
    return scored.withColumns(R.verdict_columns(FAMILIES, F.col("abstained"))).withColumnRenamed(
        stats.spec.keys[0], key
    )
