"""Merkle fixity audit of WARC replicas.

A record's leaf is the SHA-256 of its bytes; a node above covers a range of offsets, each level a multiple of the
one below, and hashes its children in the order of their offsets; the root of a file covers all of it. Ranges lie at
fixed offsets, so a lost record disturbs only its own branch. Two replicas' roots are compared file by file, and only
branches that differ are descended, level by level, to the records that differ.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urlsift.llm.common import drop_written, small, tidy, work_dir, written

#: Bytes under a node of the lowest range level, and how many ranges a node of each level above covers.
RANGE = 1 << 16
FAN = 16
#: Range levels below the root.
LEVELS = 3
RECORDS_PER_FILE = 1000
NODE = ["file", "level", "place"]


def record_bytes(page_id: Column, url: Column, html: Column) -> Column:
    """A page as a WARC resource record. Nulls are empty."""
    body = F.coalesce(html, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n"))


def laid_out(records: DataFrame, order: list[str], per_file: int = RECORDS_PER_FILE) -> DataFrame:
    """``records`` (number, length, hash, ...) put into files of ``per_file`` consecutive numbers, one record behind the other.
    Adds ``file`` and ``offset``. Only lengths and hashes move. Rows without a number form a file of their own, and
    repeated numbers stand one behind the other in the order of ``order``."""
    name = F.coalesce(F.lpad(F.floor(F.col("number") / per_file).cast("string"), 9, "0"), F.lit("unnumbered"))
    before = Window.partitionBy("file").orderBy("number", *order).rowsBetween(Window.unboundedPreceding, -1)
    placed = records.withColumn("file", F.concat(F.lit("pages-"), name, F.lit(".warc")))
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))


@dataclass(frozen=True)
class Tree:
    """Nodes of one replica: (file, level, place, hash, n), written by level. Level 0 are records (place: offset, n:
    length), level LEVELS + 1 the files' roots (place 0); n counts the records below."""

    folder: str
    nodes: DataFrame

    def level(self, k: int) -> DataFrame:
        return self.nodes.filter(F.col("level") == k)

    def drop(self) -> None:
        drop_written(self.nodes)


def _span(level: int) -> int:
    return RANGE * FAN ** (level - 1)


def build(records: DataFrame) -> Tree:
    """The tree of a replica's records (file, offset, length, hash hex). Records at one offset are hashed in the order of
    length and hash. A node has at most FAN children, the lowest as many records as start in its range. Null files or
    offsets aren't allowed."""
    spark = records.sparkSession
    folder = f"{work_dir(spark)}/merkle-{uuid.uuid4().hex}"
    leaves = records.select("file", F.col("offset").alias("place"), "hash", F.col("length").alias("n"))
    schema = "file string, place long, hash string, n long"

    def stored(nodes: DataFrame, k: int) -> DataFrame:
        nodes.write.parquet(f"{folder}/level={k}")
        return spark.read.schema(schema).parquet(f"{folder}/level={k}")

    now = stored(leaves, 0)
    for k in range(1, LEVELS + 2):
        place = F.floor(F.col("place") / (RANGE if k == 1 else FAN)) if k <= LEVELS else F.lit(0).cast("long")
        children = F.array_sort(F.collect_list(F.struct("place", F.col("n").alias("size"), "hash")))
        text = F.array_join(F.transform("children", lambda c: F.concat_ws(":", c["place"], c["size"], c["hash"])), "\n")
        count = F.count("*") if k == 1 else F.sum("n")
        grouped = now.groupBy("file", place.alias("place")).agg(children.alias("children"), count.alias("n"))
        now = stored(grouped.select("file", "place", F.sha2(text, 256).alias("hash"), "n"), k)
    return Tree(folder, spark.read.schema(f"{schema}, level int").parquet(folder))


@tidy
def audit(kept: Tree, replica: Tree) -> DataFrame:
    """(file, offset, length, found_length, hash, found_hash, damage) of each record of the first tree that is ``changed`` or
    ``missing`` in the second, or ``extra`` there. Equal records at one offset answer for each other."""
    branches = None
    for k in range(LEVELS + 1, 0, -1):
        a, b = kept.level(k), replica.level(k)
        if branches is not None:
            a, b = (x.join(small(branches), ["file", "place"], "left_semi") for x in (a, b))
        a = a.select("file", "place", F.col("hash").alias("ours"))
        b = b.select("file", "place", F.col("hash").alias("theirs"))
        differ = a.join(b, ["file", "place"], "full").filter(~F.equal_null(F.col("ours"), F.col("theirs"))).select("file", "place")
        if k == LEVELS + 1:
            spans = kept.level(LEVELS).union(replica.level(LEVELS)).select("file", "place").distinct()
            branches = spans.join(small(differ.select("file")), "file", "left_semi")
        elif k > 1:
            children = F.explode(F.sequence(F.col("place") * FAN, F.col("place") * FAN + FAN - 1))
            branches = differ.select("file", children.alias("place"))
        else:
            branches = differ
        branches = written(branches, "branches")
    branches = branches.withColumnRenamed("place", "range")

    def leaves(tree: Tree, hash_name: str, length_name: str) -> DataFrame:
        rows = tree.level(0).withColumn("range", F.floor(F.col("place") / RANGE)).join(small(branches), ["file", "range"], "left_semi")
        return rows.select("file", F.col("place").alias("offset"), F.col("n").alias(length_name), F.col("hash").alias(hash_name)).distinct()

    ours, theirs = leaves(kept, "hash", "length"), leaves(replica, "found_hash", "found_length")
    joined = ours.join(theirs, ["file", "offset"], "full").filter(~F.equal_null(F.col("hash"), F.col("found_hash")))
    damage = F.when(F.col("hash").isNull(), "extra").when(F.col("found_hash").isNull(), "missing").otherwise("changed")
    return joined.select("file", "offset", "length", "found_length", "hash", "found_hash", damage.alias("damage"))
