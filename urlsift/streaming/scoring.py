"""Scoring as a stream: the batch plan, unchanged, over a streaming source."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from urlsift.operators.fit import FittedStats
from urlsift.operators.knn import is_carried
from urlsift.plans.scoring import Models, score_records


@dataclass(frozen=True)
class BatchScores:
    """A stream of records and the plan that scores each of its batches."""

    records: DataFrame
    score: Callable[[DataFrame], DataFrame]


def score_stream(records: DataFrame, stats: FittedStats, models: Models, keep=()) -> DataFrame | BatchScores:
    """Labels and scores of a stream of raw records.

    Everything after the fit is row-local given the statistics, so the batch plan
    serves a stream as it is and keeps no state. References too large to be carried to the tasks
    are met by joins, so there the plan runs on one batch of the stream after another.
    """
    if records.isStreaming and not is_carried(models.reference):
        return BatchScores(records, lambda batch: score_records(batch, stats, models, keep))
    return score_records(records, stats, models, keep)


def write_scores(scored: DataFrame | BatchScores, path: str, checkpoint: str) -> StreamingQuery:
    """Append scores to Parquet, processing all available input; a restart resumes at the
    checkpoint. A batch scored by itself has a folder of its own, which a restart writes anew."""
    if isinstance(scored, BatchScores):
        def put(batch: DataFrame, number: int) -> None:
            scored.score(batch).write.mode("overwrite").parquet(f"{path}/batch-{number:09d}")

        writer = scored.records.writeStream.foreachBatch(put)
    else:
        writer = scored.writeStream.format("parquet").option("path", path).outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_scores`` has written, in one folder or in one for each batch."""
    return spark.read.option("recursiveFileLookup", "true").parquet(path)
