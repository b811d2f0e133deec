"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Each slot of the schedule is a point of the golden-ratio sequence mapped through the sources' cumulative
weights; slots are ranked per source. A source's documents, shuffled by a hash, are laid end to
end and cut into blocks of equal word counts; its k-th slot takes its k-th block, starting over
when they are used up. All ranks and positions are prefix sums over two levels of small groups, so no
window holds a whole source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urlsift.llm.common import small, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK = 1024
GOLDEN = 0.6180339887498949
#: Groups on each of the two levels of a prefix sum, and cells of the lookup from points to sources.
FAN = 4096


def prefix_sums(df: DataFrame, group: str, order: list[str], value: str, out: str) -> DataFrame:
    """Add the sum of ``value`` over the rows of the group before each row. ``df`` has ints ``b1`` and ``b2``, of at most
    FAN values each, that cut the order into consecutive parts."""

    def before(*cols: str) -> Window:
        return Window.partitionBy(*cols[:-1]).orderBy(cols[-1]).rowsBetween(Window.unboundedPreceding, -1)

    def exclusive(column: str, window) -> Column:
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    parts = df.groupBy(group, "b1", "b2").agg(F.sum(value).alias("part"))
    tops = parts.groupBy(group, "b1").agg(F.sum("part").alias("top"))
    tops = tops.withColumn("above", exclusive("top", before(group, "b1"))).drop("top")
    base = parts.withColumn("beside", exclusive("part", before(group, "b1", "b2"))).join(tops, [group, "b1"])
    base = base.select(group, "b1", "b2", (F.col("above") + F.col("beside")).alias("base"))
    inner = Window.partitionBy(group, "b1", "b2").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.join(base, [group, "b1", "b2"]).withColumn(out, F.col("base") + exclusive(value, inner)).drop("base")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """``sizes``: (source, source_size), one row per source. Adds ``s`` (number by code point, null last), ``target``.

    A source gets its weight's share of all words but at most ``repeats`` times its size, and what is above
    goes to the others by weight. In the order of cap over weight the capped sources come first,
    so the level is the first that leaves its own source under its cap.
    """
    s = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    share = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("s") - 1) % len(weights) + 1).cast("long")
    rows = sizes.withColumn("s", s).withColumn("weight", share).withColumn("cap", repeats * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "s")
    full = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy())
    rows = rows.withColumn("level", (total - full).cast("double") / open_weight.cast("double"))
    fits = F.col("weight") * F.col("level") <= F.col("cap")
    rank = F.row_number().over(order)
    rows = rows.withColumn("rank", rank).withColumn("first", F.min(F.when(fits, F.struct("rank", "level"))).over(Window.partitionBy()))
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.coalesce(F.col("first.level"), F.lit(0.0)))
    return rows.select("s", "source", "source_size", target.alias("target"))


@dataclass(frozen=True)
class Mix:
    """``documents`` (id, s, size, start), ``sources`` (s, source, source_size, target, quota, blocks, slots) and
    ``schedule`` (s, rank, slot, block, words): the slot's block and how many of its first words it takes.
    ``slot`` is null for closing slots, which follow all others."""

    documents: DataFrame
    sources: DataFrame
    schedule: DataFrame
    block: int

    def taken(self) -> DataFrame:
        """(id, size, source_size, target, taken) for each document row."""
        sized = self.documents.filter("size > 0")
        last = F.floor((F.col("start") + F.col("size") - 1) / self.block)
        pieces = sized.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / self.block), last)))
        head = F.col("block") * self.block
        pieces = pieces.withColumn("a", F.greatest(F.col("start") - head, F.lit(0)))
        pieces = pieces.withColumn("b", F.least(F.col("start") + F.col("size") - head, F.lit(self.block)))
        joined = pieces.join(self.schedule.select("s", "block", "words"), ["s", "block"], "left")
        words = F.greatest(F.least("b", F.coalesce("words", F.lit(0))) - F.col("a"), F.lit(0))
        sums = joined.groupBy("id", "s", "size", "start").agg(F.sum(words).alias("taken"))
        rest = self.documents.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
        found = sums.select("id", "s", "size", "taken").union(rest.select("id", "s", "size", "taken"))
        named = found.join(small(self.sources.select("s", "source", "source_size", "target")), "s")
        return named.select("id", "source", "size", "source_size", "target", "taken")

    def slots(self) -> DataFrame:
        """(id, size, slots, first_slot, last_slot) for each document row: how many slots of the schedule take words of it, and the first and
        last of those; null where none does, or none but closing slots."""
        sized = self.documents.filter("size > 0")
        last = F.floor((F.col("start") + F.col("size") - 1) / self.block)
        pieces = sized.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / self.block), last)))
        reached = F.col("words") > F.greatest(F.col("start") - F.col("block") * self.block, F.lit(0))
        met = pieces.join(self.schedule.select("s", "block", "slot", "words"), ["s", "block"], "left")
        sums = met.groupBy("id", "s", "size", "start").agg(
            F.count_if(reached).alias("slots"), F.min(F.when(reached, F.col("slot"))).alias("first_slot"), F.max(F.when(reached, F.col("slot"))).alias("last_slot"),
        )
        none = F.lit(None).cast("long")
        rest = self.documents.filter("size = 0").select("id", "size", F.lit(0).cast("long").alias("slots"), none.alias("first_slot"), none.alias("last_slot"))
        return sums.select("id", "size", "slots", "first_slot", "last_slot").union(rest)


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS,
    repeats: int = MAX_REPEATS, block: int = BLOCK,
) -> Mix:
    """Plan the mix of all documents. A null text has no words and is never taken; null is a source of its own, the
    last; rows that repeat an id are documents of their own; an empty table gives empty frames. Reruns agree: the
    shuffle is a hash of the id. A document longer than a block lies in several. Other columns aren't read."""
    spark = docs.sparkSession
    size = F.size(F.regexp_extract_all(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), F.lit(WORD), F.lit(0)))
    key = F.md5(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")))
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{source}`").alias("source"), size.cast("long").alias("size"), key.alias("key"))
    rows = written(rows, "mix-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = targets(sizes, weights, repeats).withColumn("quota", F.floor("target"))
    blocks = F.ceil(F.col("source_size") / block)
    passes = F.coalesce(F.floor(F.try_divide("quota", "source_size")), F.lit(0))
    rest = F.ceil((F.col("quota") - passes * F.col("source_size")) / block)
    sources = written(sources.withColumn("blocks", blocks).withColumn("slots", passes * blocks + rest), "mix-sources")

    number = small(sources.select("s", F.col("source").alias("of")))
    cut = lambda a: F.conv(F.substring("key", a, 3), 16, 10).cast("int")
    numbered = rows.join(number, F.equal_null(F.col("source"), F.col("of"))).select(
        "id", "s", "size", "key", cut(1).alias("b1"), cut(4).alias("b2")
    )
    documents = prefix_sums(numbered, "s", ["key", "id", "size"], "size", "start").select("id", "s", "size", "start")
    return Mix(documents, sources, written(_schedule(spark, sources, block), "mix-schedule"), block)


def _schedule(spark, sources: DataFrame, block: int) -> DataFrame:
    n = sources.agg(F.sum("slots")).first()[0] or 0
    order = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = sources.filter("slots > 0").withColumn("hi", F.sum("slots").over(order))
    spans = spans.withColumn("lo", F.col("hi") - F.col("slots"))
    cell = lambda x: F.least(F.floor(x * FAN / F.lit(max(n, 1))), F.lit(FAN - 1))
    cells = spans.select("s", "lo", "hi", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi")))).alias("cell"))
    point = F.col("slot") * GOLDEN - F.floor(F.col("slot") * GOLDEN)
    slots = spark.range(n).withColumnRenamed("id", "slot").withColumn("x", F.floor(point * n)).withColumn("cell", cell(F.col("x")))
    drawn = slots.join(small(cells), "cell").filter("x >= lo and x < hi").select("slot", "s", F.lit(1).cast("long").alias("one"))
    step = max(1, -(-n // FAN))
    inner = max(1, -(-step // FAN))
    drawn = drawn.withColumn("b1", F.floor(F.col("slot") / step).cast("int"))
    drawn = drawn.withColumn("b2", F.floor((F.col("slot") % step) / inner).cast("int"))
    ranked = prefix_sums(drawn, "s", ["slot"], "one", "rank").select("s", "rank", "slot")
    have = drawn.groupBy("s").agg(F.count("*").alias("have"))
    short = sources.join(have, "s", "left").withColumn("have", F.coalesce("have", F.lit(0))).filter("have < slots")
    closing = short.select("s", F.explode(F.sequence(F.col("have"), F.col("slots") - 1)).alias("rank"), F.lit(None).cast("long").alias("slot"))
    placed = ranked.union(closing).join(small(sources), "s").filter("rank < slots")
    number = F.try_mod("rank", "blocks")
    before = F.floor(F.try_divide("rank", "blocks")) * F.col("source_size") + number * block
    inside = F.least(F.lit(block), F.col("source_size") - number * block, F.col("quota") - before)
    return placed.select("s", "rank", "slot", number.alias("block"), inside.cast("long").alias("words"))
