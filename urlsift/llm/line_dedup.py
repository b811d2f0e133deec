"""Line deduplication over levelled sorted runs of line hashes.

Documents come in batches of ascending ids. A run holds the keys one batch was the first to bring, each
once, as two 64-bit hashes with the document that owns it; runs are stored bucketed and sorted by the
hashes, so a batch's keys merge-anti-join them without moving a run. What is left becomes the batch's own
run. Whenever ``fanout`` runs stand on a level they are merged into one of the next. A line goes if an
older run holds its key or a smaller document of its batch owns it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urlsift.llm.common import ascii_lower, drop_written, small, work_dir, written

SPACE = " \t\n\x0b\x0c\r"
MIN_POINTS = 10
HASHES = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


class LineRuns:
    """The levels of runs. ``take`` anti-joins new keys with all of them and adds what is new."""

    def __init__(self, spark: SparkSession, fanout: int = 2):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[str]] = []
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder = f"{work_dir(spark)}/line-runs-{uuid.uuid4().hex}"

    def _store(self, keys: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        stored = keys.write.bucketBy(self.buckets, *HASHES).sortBy(*HASHES).option("path", f"{self.folder}/{name}")
        stored.saveAsTable(name)
        return name

    def _drop(self, name: str) -> None:
        files = self.spark.table(name)
        drop_written(files)
        self.spark.sql(f"DROP TABLE {name}")

    def files(self, name: str) -> DataFrame:
        """The rows of a run, without its order."""
        return self.spark.read.schema(self.spark.table(name).schema).parquet(f"{self.folder}/{name}")

    def take(self, keys: DataFrame) -> str:
        """``keys``: one row per key with its owner. Returns the name of the run made of those no run held."""
        for name in (n for level in self.levels for n in level):
            keys = keys.join(self.spark.table(name), HASHES, "left_anti")
        name = self._store(keys)
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(name)
        return name

    def compact(self) -> None:
        """Merge each level that is full into one run of the next."""
        for depth in range(len(self.levels)):
            full = self.levels[depth]
            if len(full) < self.fanout:
                continue
            merged = self.spark.table(full[0])
            for name in full[1:]:
                merged = merged.union(self.spark.table(name))
            merged = self._store(merged.repartition(self.buckets, *HASHES))
            if depth + 1 == len(self.levels):
                self.levels.append([])
            self.levels[depth + 1].append(merged)
            self.levels[depth] = []
            for name in full:
                self._drop(name)

    def clear(self) -> None:
        for level in self.levels:
            for name in level:
                self._drop(name)
        self.levels = []


def _bounds(docs: DataFrame, batches: int) -> list:
    """Ids that end the batches, in the order of the ids."""
    if batches < 2:
        return []
    if isinstance(docs.schema["id"].dataType, T.NumericType):
        cuts = docs.select(F.col("id").cast("double").alias("id")).approxQuantile("id", [k / batches for k in range(1, batches)], 0.001)
        return sorted({int(c) for c in cuts})
    ranged = docs.select("id").filter("id is not null").repartitionByRange(batches, "id")
    ends = ranged.groupBy(F.spark_partition_id().alias("r")).agg(F.max("id").alias("end")).collect()  # a row for each range
    return sorted(r.end for r in ends)[:-1]


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", batches: int = 4, fanout: int = 2, min_points: int = MIN_POINTS
) -> DataFrame:
    """One row per document row: ``doc`` (struct of all its columns), ``n_lines``, ``n_dropped``, ``kept``.

    A null or empty text is one empty line. Keys of fewer than ``min_points`` code points never go. Rows that
    share an id are one document: all keep a line that the document owns. Null ids are one document behind
    all others. An empty table gives an empty result. Hashes alone move, and texts stay where they are while the places of all
    lines that go are small enough to be broadcast; beyond that the documents are shuffled once to meet them. Batches follow
    the order of the ids: of numbers by their quantiles, of other ids by ranges.
    """
    spark = docs.sparkSession
    docs = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")).select(
        "doc", F.col(f"doc.`{doc_id}`").alias("id"), F.coalesce(F.col(f"doc.`{text}`").cast("string"), F.lit("")).alias("t")
    ).withColumn("th", F.xxhash64("t"))
    late = [F.when(F.col("id") > F.lit(b), 1).otherwise(0) for b in _bounds(docs, batches)]
    batch = F.when(F.col("id").isNull(), len(late)).otherwise(sum(late, F.lit(0)))

    lines = docs.select("id", "th", batch.alias("batch"), F.posexplode(F.split("t", "\n", -1)).alias("pos", "line"))
    lines = lines.withColumn("key", F.btrim("line", F.lit(SPACE))).filter(F.length("key") >= min_points)
    lines = lines.withColumn("key", ascii_lower(F.col("key")))
    lines = lines.select(
        "id", "th", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "batch"
    )
    folder = f"{work_dir(spark)}/lines-{uuid.uuid4().hex}"
    lines.write.partitionBy("batch").parquet(folder)
    schema = f"id {docs.schema['id'].dataType.simpleString()}, th long, pos int, h1 long, h2 long, batch int"
    stored = spark.read.schema(schema).parquet(folder)

    runs, gone = LineRuns(spark, fanout), []
    for k in range(len(late) + 1):
        own = stored.filter(F.col("batch") == k).drop("batch")
        first = own.groupBy(*HASHES).agg(F.min("id").alias("owner"))
        fresh = runs.files(runs.take(first)).withColumn("fresh", F.lit(True))
        kept = F.col("fresh").isNotNull() & F.col("owner").eqNullSafe(F.col("id"))
        lost = own.join(fresh, HASHES, "left").filter(~kept)
        gone.append(written(lost.groupBy("id", "th").agg(F.collect_set("pos").alias("gone")), "lines-gone"))
        if k < len(late):
            runs.compact()
    runs.clear()
    drop_written(stored)

    lost = gone[0]
    for more in gone[1:]:
        lost = lost.union(more)
    lost = small(lost.withColumnsRenamed({"id": "lost_id", "th": "lost_th"}))
    joined = docs.join(lost, F.col("id").eqNullSafe(F.col("lost_id")) & (F.col("th") == F.col("lost_th")), "left")
    parts = F.split("t", "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), "gone")
    kept = F.array_join(F.transform(left, lambda i: F.get(parts, i)), "\n")
    return joined.select(
        "doc",
        F.size(parts).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("t")).otherwise(kept).alias("kept"),
    )
