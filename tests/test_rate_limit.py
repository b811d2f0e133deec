"""Windows of sessions without gaps, requests without a time, and batch against stream."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from urlsift.streaming import rate_limit as RL

SCHEMA = "s string, r long, t timestamp"
START = dt.datetime(2024, 1, 1)


def sequential(rows, limit, window):
    state, out = {}, {}
    for s, r, t in sorted((x for x in rows if x[2]), key=lambda x: (x[2], x[1])):
        start, used = state.get(s, (None, 0))
        if start is None or (t - start).total_seconds() > window:
            start, used = t, 0
        out[r], state[s] = (used < limit, max(limit - 1 - used, 0)), (start, used + 1)
    return out | {r: (False, 0) for _, r, t in rows if t is None}


def sessions(seed, n):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", None, "hot", "hot"]), i, START + dt.timedelta(seconds=rng.choice([1, 7]) * rng.randint(0, n))) for i in range(n)]
    return rows + [("hot", n + 1, None), ("only", n + 2, None), (None, n + 3, None)]


@pytest.mark.parametrize("segment_rows", [0, 50, 100_000])
def test_every_path_gives_the_same(spark, segment_rows):
    rows = sessions(segment_rows, 900)
    got = RL.grant_batch(
        spark.createDataFrame(rows, SCHEMA).repartition(5), session="s", request="r", at="t", limit=3, window_seconds=40,
        segment_rows=segment_rows, rows_per_range=70,
    ).collect()
    assert len(got) == len(rows) and {x.request: (x.granted, x.remaining) for x in got} == sequential(rows, 3, 40)


def test_stream_equals_batch_with_missing_times(spark, tmp_path):
    rows = sessions(4, 200)
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    stream = RL.grant_stream(source, session="s", request="r", at="t", limit=3, window_seconds=40)
    out = str(tmp_path / "out")
    assert stream.writeStream.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).format("parquet").start(out).awaitTermination(120)
    got = spark.read.parquet(out).collect()
    assert len(got) == len(rows) and {x.request: (x.granted, x.remaining) for x in got} == sequential(rows, 3, 40)
    assert sum(x.at_us is None for x in got) == 3


def test_a_gapless_session_spreads_over_tasks(spark):
    rows = spark.range(200_000).select(F.lit("one").alias("s"), F.col("id").alias("r"), F.timestamp_seconds(F.col("id") * 3).alias("t"))
    got = RL.grant_batch(rows, session="s", request="r", at="t", limit=2, window_seconds=10, segment_rows=1000, rows_per_range=20_000)
    # windows of four requests: 0, 3, 6 and 9 seconds
    wrong = got.filter((F.col("granted") != (F.col("request") % 4 < 2)) | (F.col("remaining") != F.when(F.col("request") % 4 == 0, 1).otherwise(0)))
    assert got.count() == 200_000 and wrong.count() == 0


def test_no_requests(spark):
    assert RL.grant_batch(spark.createDataFrame([], SCHEMA), session="s", request="r", at="t").collect() == []
