"""Per-session rate limit: a window opens at a session's first request, holds a fixed
number of grants, and is replaced by the first request more than its length later."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from urlsift import constants as K
from urlsift.operators.ordering import ROWS_PER_RANGE, positions, running_extremes
from urlsift.runtime import drop_written, small, tidy, written

#: Requests of a segment that one task reads in order.
SEGMENT_ROWS = 100_000


def _requests(requests: DataFrame, session: str, request: str, at: str) -> DataFrame:
    """session and request in their own types, and the time in microseconds."""
    return requests.select(
        F.col(session).alias("session"), F.col(request).alias("request"),
        F.unix_micros(F.col(at).cast("timestamp")).alias("at_us"),
    )


def _output(slim: DataFrame) -> T.StructType:
    fields = [slim.schema[c] for c in ("session", "request", "at_us")]
    return T.StructType([*fields, T.StructField("granted", T.BooleanType()), T.StructField("remaining", T.IntegerType())])


def _windows(at: np.ndarray, start: int | None, used: int, window_us: int):
    """Place of each request within its window, for ascending times of one session that continue a window
    which began at ``start`` with ``used`` requests; and the last window's start and requests."""
    place, i, n = np.empty(len(at), np.int64), 0, len(at)
    while i < n:
        if start is None or at[i] - start > window_us:
            start, used = int(at[i]), 0
        end = int(np.searchsorted(at, start + window_us, side="right"))
        place[i:end] = used + np.arange(end - i)
        used, i = used + end - i, end
    return place, start, used


def grant_stream(
    requests: DataFrame, *, session: str, request: str, at: str, limit: int = K.RATE_PER_SESSION,
    window_seconds: int = K.RATE_WINDOW_SECONDS, forget: str | None = None,
) -> DataFrame:
    """Decide every request of a stream, one row for each; state is two numbers per session.

    Rows of one session within a micro-batch are taken in time order. A late request, older than the open window,
    is decided against that window: it takes a grant of it or is refused. A request without a time is refused and takes no grant. With ``forget``, which is for streams that run
    on, the state of a session that sends nothing for that processing time is dropped, and it starts anew.
    """
    window_us = window_seconds * 1_000_000
    slim = _requests(requests, session, request, at)
    idle_ms = int(pd.Timedelta(forget).total_seconds() * 1000) if forget else None
    timeout = GroupStateTimeout.ProcessingTimeTimeout if forget else GroupStateTimeout.NoTimeout

    def decide(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        start, used = state.get if state.exists else (None, 0)
        # one session's rows of one micro-batch
        rows = pd.concat(list(batches)).sort_values(["at_us", "request"], na_position="last")
        timed = int(rows["at_us"].notna().sum())
        place, start, used = _windows(rows["at_us"].to_numpy()[:timed].astype(np.int64), start, used, window_us)
        place = np.append(place, np.full(len(rows) - timed, limit))
        if start is not None:
            state.update((start, used))
        if idle_ms and start is not None:
            state.setTimeoutDuration(idle_ms)
        yield pd.DataFrame(
            {"session": [key[0]] * len(rows), "request": rows["request"].to_numpy(), "at_us": rows["at_us"].astype("Int64").to_numpy(dtype=object, na_value=None),
             "granted": place < limit, "remaining": np.maximum(limit - 1 - place, 0).astype(np.int32)}
        )

    return slim.groupBy("session").applyInPandasWithState(
        decide, _output(slim), "start long, used long", "append", timeout
    )


def with_segments(slim: DataFrame, window_us: int, slot_windows: int = 64) -> DataFrame:
    """Add ``segment``: the time of the session's last request that came more than a window after the one before.

    Such a request opens a window whatever came before, so segments are independent. Gaps are sought within time
    slots of each session and between the slots' ends, so a hot session is many small groups.
    """
    slot = F.floor(F.col("at_us") / (window_us * slot_windows))
    rows = slim.filter("at_us is not null").withColumn("_slot", slot)
    inside = Window.partitionBy("session", "_slot").orderBy("at_us")
    opens = F.when(F.col("at_us") - F.lag("at_us").over(inside) > window_us, F.col("at_us"))
    rows = rows.withColumn("_opens", opens)
    slots = rows.groupBy("session", "_slot").agg(
        F.min("at_us").alias("_first"), F.max("at_us").alias("_last"), F.max("_opens").alias("_open")
    )
    over = Window.partitionBy("session").orderBy("_slot")
    gap = F.col("_first") - F.lag("_last").over(over)
    slots = slots.withColumn("_head", F.when(gap.isNull() | (gap > window_us), F.col("_first")))
    latest = F.last(F.coalesce("_open", "_head"), ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1))
    slots = slots.select(F.col("session").alias("_s"), F.col("_slot").alias("_k"), F.coalesce("_head", latest).alias("_carried"))
    joined = rows.join(slots, F.equal_null(F.col("session"), F.col("_s")) & (F.col("_slot") == F.col("_k")))
    upto = inside.rangeBetween(Window.unboundedPreceding, 0)
    segment = F.coalesce(F.max("_opens").over(upto), F.col("_carried"))
    return joined.withColumn("segment", segment).select(*slim.columns, "segment")


def _places(segments: DataFrame, slim: DataFrame, window_us: int, limit: int) -> DataFrame:
    """Decisions where each segment is read in time order by one task, with two numbers of state."""

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, start, used = None, None, 0
        for rows in batches:
            marks = rows["_segment"].to_numpy()
            cuts = np.flatnonzero(np.append(True, marks[1:] != marks[:-1]))
            at_us, place = rows["at_us"].to_numpy(), np.empty(len(rows), np.int64)
            for a, b in zip(cuts, np.append(cuts[1:], len(rows)), strict=True):
                if marks[a] != current:
                    current, start, used = marks[a], None, 0
                place[a:b], start, used = _windows(at_us[a:b], start, used, window_us)
            yield rows.drop(columns="_segment").assign(granted=place < limit, remaining=np.maximum(limit - 1 - place, 0).astype(np.int32))

    # a text that names session and segment, whatever the session's type
    name = F.concat_ws("|", F.col("segment").cast("string"), F.coalesce(F.col("session").cast("string"), F.lit("\0null")))
    ordered = segments.withColumn("_segment", name).select(*slim.columns, "_segment")
    ordered = ordered.repartition("_segment").sortWithinPartitions("_segment", "at_us", "request")
    return ordered.mapInPandas(decide, _output(slim))


def window_openers(points: DataFrame, window_us: int, by: Sequence[str], rows_per_range: int) -> DataFrame:
    """(by, opened): of the distinct times ``at_us`` of each group those that open a window, by pointer doubling.

    Each time points to the first one beyond its window, the least time seen so far in a descending order that is cut into ranges. The
    group's first time opens a window; if the first n openers are marked and each time points n windows on, the marked
    ones' pointers give the next n. So pointers and marks double with each round, whatever a group's size.
    """
    points = written(points.select(*by, "at_us").distinct(), "times")
    none = F.lit(None).cast("long")
    ends = points.select(*by, (F.col("at_us") + window_us).alias("at"), F.lit(0).alias("kind"), none.alias("seen"), F.col("at_us").alias("a"))
    starts = points.select(*by, F.col("at_us").alias("at"), F.lit(1).alias("kind"), F.col("at_us").alias("seen"), none.alias("a"))
    found = running_extremes(ends.union(starts), "at", {"b": F.col("seen")}, tie=["kind"], by=by, descending=True, rows_per_range=rows_per_range)
    jumps = written(found.filter("a is not null and b is not null").select(*by, "a", "b"), "jumps")
    marks = [written(points.groupBy(*by).agg(F.min("at_us").alias("opened")), "openers")]
    while True:
        known = marks[0]
        for more in marks[1:]:
            known = known.union(more)
        known = known.select(*[F.col(c).alias(f"_{c}") for c in by], "opened")
        same = [F.equal_null(F.col(c), F.col(f"_{c}")) for c in by]
        more = written(jumps.join(known, [*same, F.col("a") == F.col("opened")]).select(*by, F.col("b").alias("opened")), "openers")
        if not more.limit(1).count():
            break
        marks.append(more)
        on = jumps.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("a").alias("a2"), F.col("b").alias("b2"))
        farther = written(jumps.join(on, [*same, F.col("b") == F.col("a2")]).select(*by, "a", F.col("b2").alias("b")), "jumps")
        drop_written(jumps)
        jumps = farther
    drop_written(points)
    whole = marks[0]
    for part in marks[1:]:
        whole = whole.union(part)
    return whole


def _doubled(segments: DataFrame, slim: DataFrame, window_us: int, limit: int, rows_per_range: int) -> DataFrame:
    """Decisions for segments of any size: openers by doubling, each request's opener and its place behind it by ranges."""
    by = ["session", "segment"]
    rows = written(segments, "requests")
    openers = written(window_openers(rows, window_us, by, rows_per_range), "openers")
    none = F.lit(None).cast("long")
    row_type = slim.schema["request"].dataType
    heads = openers.select(*by, F.lit(None).cast(row_type).alias("request"), F.col("opened").alias("at_us"), F.lit(0).alias("kind"), "opened")
    asks = rows.select(*by, "request", "at_us", F.lit(1).alias("kind"), none.alias("opened"))
    found = running_extremes(heads.union(asks), "at_us", {"window": F.col("opened")}, tie=["kind", "request"], by=by, rows_per_range=rows_per_range)
    placed = positions(found.filter("kind = 1").drop("kind", "opened"), "at_us", tie=["request"], by=[*by, "window"], name="place", rows_per_range=rows_per_range)
    place = F.col("place") - 1
    left = F.greatest(F.lit(limit - 1) - place, F.lit(0)).cast("int")
    return placed.select(*slim.columns, (place < limit).alias("granted"), left.alias("remaining"))


@tidy
def grant_batch(
    requests: DataFrame, *, session: str, request: str, at: str, limit: int = K.RATE_PER_SESSION,
    window_seconds: int = K.RATE_WINDOW_SECONDS, segment_rows: int = SEGMENT_ROWS, rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """The same decisions over a table of requests.

    Sessions are cut at gaps longer than a window. Segments of at most ``segment_rows`` requests are sorted and read as a stream of
    Arrow batches with two numbers of state; of larger ones the windows are found by pointer doubling, and the requests' places
    in them by ranges of their order, so that a session without a gap spreads over all tasks. A request without a time is refused and
    takes no grant, as in the stream.
    """
    window_us = window_seconds * 1_000_000
    slim = written(_requests(requests, session, request, at), "all-requests")
    cut = written(with_segments(slim, window_us), "segments")
    large = cut.groupBy("session", "segment").agg(F.count("*").alias("n")).filter(F.col("n") > segment_rows)
    large = written(large.select(F.col("session").alias("_s"), F.col("segment").alias("_g")), "large-segments")
    of_large = F.equal_null(F.col("session"), F.col("_s")) & (F.col("segment") == F.col("_g"))
    refused = slim.filter("at_us is null").withColumns({"granted": F.lit(False), "remaining": F.lit(0)})
    if not large.limit(1).count():
        return _places(cut, slim, window_us, limit).union(refused)
    few = cut.join(small(large), of_large, "left_anti")
    many = cut.join(small(large), of_large, "left_semi")
    return _places(few, slim, window_us, limit).union(_doubled(many, slim, window_us, limit, rows_per_range)).union(refused)
