"""Session helpers: the shared work folder, written intermediate tables, size-checked joins."""

from __future__ import annotations

import functools
import tempfile
import threading
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup side whose values take at most this many bytes is broadcast.
BROADCAST_BYTES = 32 << 20

_running = threading.local()
_folders: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where the setting is absent, a session of one machine gets a temporary folder;
    on a cluster a machine-local path would be lost with its machine, so there it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _folders:
        _folders[app] = tempfile.mkdtemp(prefix="urlsift-work-")
    return _folders[app]


def written(df: DataFrame, name: str = "table", **options: str) -> DataFrame:
    """Write the frame to the work folder and read it back: a lineage cut that
    survives the loss of any executor. ``options`` go to the writer."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    for tables in getattr(_running, "runs", [])[-1:]:
        tables.append(table)
    return table


def tidy(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator that writes its result and then deletes every other table that was written while it ran,
    so that a run leaves nothing but what it returns, and nothing where it fails."""

    @functools.wraps(operator)
    def run(*args, **named) -> DataFrame:
        runs = _running.__dict__.setdefault("runs", [])
        runs.append([])
        kept = None
        try:
            kept = written(operator(*args, **named), "result")
        finally:
            for table in runs.pop():
                if table is not kept:
                    drop_written(table)
        for tables in runs[-1:]:
            tables.append(kept)
        return kept

    return run


def drop_written(df: DataFrame) -> None:
    """Delete the files of a table made by ``written`` that nothing reads any more."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    base = jvm.org.apache.hadoop.fs.Path(work_dir(spark)).toUri().getPath()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if path.toUri().getPath().startswith(f"{base}/"):
            path.getFileSystem(conf).delete(path, True)


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all values as text, and a few for each."""
    widths = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + F.lit(16) for c in df.columns]
    return df.agg(F.sum(sum(widths[1:], widths[0]).cast("long"))).first()[0] or 0


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The frame with a broadcast hint if it measures at most ``limit`` bytes, else as it is."""
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def lookup_join(rows: DataFrame, table: DataFrame, on: Sequence[str], limit: int = BROADCAST_BYTES) -> DataFrame:
    """Left-join a lookup table: broadcast while it is measured to be small, so that the rows
    don't move; beyond that a sort-merge join, of which the adaptive planner splits hot keys."""
    return rows.join(small(table, limit), list(on), "left")


def spread(df: DataFrame) -> DataFrame:
    """Rebalance a freshly read table that has fewer partitions than the session has
    slots, as a single small file has. A table with enough partitions stays as it is."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df
