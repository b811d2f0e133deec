"""Prefix trie of conversations, rolled up by centroid decomposition of its parent edges.

A node is a distinct sequence of first turns. Its key is its depth and the running exclusive-or of the hashes
(two of 64 bits) of its turns and their places; its name is its smallest conversation and its depth. The subtree's
rows (conversation, depth) of every node come from one grouping, since each member passes once through each of
its nodes on the way down: they are the weights by which components are split.

The rollup is balanced whatever the trie's depth. In each round every component has its centroid taken out: the deepest node
with more than half of the component's weight under it. The total of the centroid's side is added along the path
from the centroid to the component's top, whose weights shrink by what was cut off; what lies under each child of
the centroid and what is left above become the next round's components. Which child a node lies under, and which
nodes are on a path, is looked up in the table (conversation, depth) -> node, so a round is a fixed number of joins and
weights halve. Components of at most ``block`` rows are folded in depth order inside a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urlsift.llm.common import drop_written, small, tidy, written
from urlsift.operators.ordering import positions

#: Conversations whose numbers agree without the remainder by GROUP share their beginning; HEADS bounds its turns.
GROUP, HEADS = 5, 9
#: Rows of a component that one task folds.
BLOCK = 10_000
#: Turns of a conversation in one window.
TURNS = 1_024
ROWS_PER_RANGE = 20_000
#: Bytes of conversation numbers that are joined to one piece before pieces are hashed in order.
PIECE = 1 << 16

NODE = ["m", "d"]
COMP = ["top_m", "top_d"]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(c, j, x1, x2, bytes): the turns of each conversation from 1 on, by turn (null first), then role, then text.
    Only turns that share their place carry their text to the sort."""
    rows = conversations.select(
        F.col(f"`{conv_id}`").cast("long").alias("c"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    ).filter("c is not null")
    shared = rows.groupBy("c", "turn").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("c").alias("sc"), F.col("turn").alias("st"))
    shared = small(written(shared, "shared-places"))
    marked = rows.join(shared, (F.col("c") == F.col("sc")) & F.equal_null("turn", "st"), "left")
    length = F.octet_length("text").cast("long")
    keyed = marked.select(
        "c", "turn", "role", F.when(F.col("sc").isNotNull(), F.col("text")).alias("tie"), length.alias("bytes"),
        F.xxhash64(F.length("role"), "role", "text").alias("x1"), F.xxhash64("text", "role", F.lit(1)).alias("x2"),
    ).withColumn("row", F.monotonically_increasing_id())
    found = positions(keyed, "turn", tie=["role", "tie", "row"], by=["c"], name="j", rows_per_range=ROWS_PER_RANGE)
    return written(found.select("c", F.col("j").cast("long").alias("j"), "x1", "x2", "bytes"), "turns")


def _rebuilt(turns: DataFrame, group: int, heads: int) -> DataFrame:
    """(c, d, len, x1, x2, bytes): each conversation's first turns from its group's first conversation, then its own; and a row
    of depth zero for each, turnless ones too."""
    convs = turns.groupBy("c").agg(F.max("j").alias("own"))
    h = F.crc32(F.col("c").cast("string").cast("binary")) % heads
    convs = written(convs.withColumns({"h": h, "base": F.col("c") - F.col("c") % group}), "conversations")
    lengths = convs.select(F.col("c").alias("base"), F.col("own").alias("base_own"))
    given = F.least("h", F.coalesce("base_own", F.lit(0)))
    convs = convs.join(small(lengths), "base", "left").withColumn("given", given)
    convs = convs.withColumn("len", F.col("given") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = written(convs.select("c", "base", "h", "given", "len"), "lengths")
    value = ["x1", "x2", "bytes"]
    first = turns.filter(F.col("j") < heads).select(F.col("c").alias("base"), "j", *value)
    given_rows = convs.join(first, "base").filter("j <= given").select("c", F.col("j").alias("d"), "len", *value)
    after = turns.join(small(convs), "c").filter("j > h")
    own_rows = after.select("c", (F.col("given") + F.col("j") - F.col("h")).alias("d"), "len", *value)
    zero = F.lit(0).cast("long")
    roots = convs.select("c", zero.alias("d"), "len", *[zero.alias(v) for v in value])
    placed = given_rows.union(own_rows).withColumns({x: F.xxhash64("d", x) for x in ("x1", "x2")})
    return written(roots.union(placed), "rebuilt")


def _prefixes(rows: DataFrame, block: int = TURNS) -> DataFrame:
    """Replace x1 and x2 by their exclusive-or over all rows of the conversation ``c`` up to the place ``d``. No window holds
    more than ``block`` rows: longer conversations are cut, and the totals of the cuts are run up in the same way."""
    deepest = rows.agg(F.max("d")).first()[0]
    cut = F.floor(F.col("d") / block).cast("long")
    order = Window.partitionBy("c", "cut").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    run = rows.withColumn("cut", cut).withColumns({x: F.bit_xor(x).over(order) for x in ("x1", "x2")})
    if deepest is None or deepest < block:
        return run.drop("cut")
    totals = rows.withColumn("cut", cut).groupBy("c", F.col("cut").alias("d")).agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    before = _prefixes(totals, block).select("c", (F.col("d") + 1).alias("cut"), F.col("x1").alias("b1"), F.col("x2").alias("b2"))
    joined = run.join(before, ["c", "cut"], "left")
    added = {x: F.col(x).bitwiseXOR(F.coalesce(b, F.lit(0).cast("long"))) for x, b in (("x1", "b1"), ("x2", "b2"))}
    return joined.withColumns(added).drop("cut", "b1", "b2")


def _folded(rows: DataFrame) -> DataFrame:
    """Whole components in a task each: deepest nodes first, every node hands its sums on to its parent."""

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held = None, {}
        for batch in batches:
            col = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            leaves, saved = col["acc_leaves"], col["acc_saved"]
            for i, (top_m, top_d, m, d, up) in enumerate(zip(col["top_m"], col["top_d"], col["m"], col["d"], col["up"], strict=True)):
                if (top_m, top_d) != here:
                    here, held = (top_m, top_d), {}
                under_leaves, under_saved = held.pop((m, d), (0, 0))
                under_leaves, under_saved = under_leaves + col["leaf"][i], under_saved + col["saved"][i]
                leaves[i] += under_leaves
                saved[i] += under_saved
                if up is not None:
                    a, b = held.get((up, d - 1), (0, 0))
                    held[up, d - 1] = (a + under_leaves, b + under_saved)
            yield pa.RecordBatch.from_arrays([batch.column("m"), batch.column("d"), pa.array(leaves, pa.int64()), pa.array(saved, pa.int64())], [*NODE, "n_leaves", "saved_tokens"])

    dealt = rows.repartition(*COMP).sortWithinPartitions(*COMP, F.col("d").desc())
    return dealt.mapInArrow(fold, "m long, d long, n_leaves long, saved_tokens long")


def roll_up(tree: DataFrame, paths: DataFrame, block: int) -> DataFrame:
    """(m, d, n_leaves, saved_tokens): sums of ``leaf`` and ``saved`` over each node's subtree. ``tree`` (m, d, up, under, leaf, saved):
    ``up`` is the parent's m, ``under`` the weight of the subtree; ``paths`` (c, d, m, up): the nodes of each conversation that names one."""
    zero = F.lit(0).cast("long")
    state = tree.withColumns({"acc_leaves": zero, "acc_saved": zero, "top_m": F.lit(None).cast("long"), "top_d": zero})
    state, parts, out = written(state, "components"), [], NODE + ["n_leaves", "saved_tokens"]
    while True:
        weights = state.groupBy(*COMP).agg(F.max("under").alias("weight"))
        weights = written(weights, "weights")
        same = [F.equal_null(state[k], weights[k]) for k in COMP]
        sized = state.join(small(weights), same).drop(*[weights[k] for k in COMP])
        parts.append(written(_folded(sized.filter(F.col("weight") <= block)), "folded"))
        if not weights.filter(F.col("weight") > block).limit(1).count():
            break
        large = written(sized.filter(F.col("weight") > block), "large")
        drop_written(state)
        drop_written(weights)
        deepest = large.filter(2 * F.col("under") > F.col("weight")).groupBy(*COMP).agg(F.max(F.struct("d", "m", "under")).alias("v"))
        cut = written(deepest.select(*[F.col(k).alias(f"of_{k}") for k in COMP], "v.*").toDF("of_m", "of_d", "vd", "vm", "v_under"), "centroids")
        placed = large.join(small(cut), F.equal_null("top_m", "of_m") & (F.col("top_d") == F.col("of_d"))).drop("of_m", "of_d")
        child = paths.select(F.col("c").alias("pc"), (F.col("d") - 1).alias("pd"), F.col("m").alias("child"), F.col("up").alias("child_up"))
        deeper = placed.filter("d > vd").join(child, (F.col("m") == F.col("pc")) & (F.col("vd") == F.col("pd"))).drop("pc", "pd")
        none = F.lit(None).cast("long")
        placed = deeper.union(placed.filter("d <= vd").withColumns({"child": none, "child_up": none}).select(deeper.columns))
        is_v = (F.col("d") == F.col("vd")) & (F.col("m") == F.col("vm"))
        side = F.when((F.col("d") > F.col("vd")) & (F.col("child_up") == F.col("vm")), F.lit(2)).when(is_v, F.lit(1)).otherwise(F.lit(0))
        placed = written(placed.withColumn("side", side).drop("child_up"), "placed")
        totals = placed.filter("side > 0").groupBy("vm", "vd").agg(F.sum("leaf").alias("add_leaves"), F.sum("saved").alias("add_saved"))
        totals = written(cut.join(totals, ["vm", "vd"]), "totals")
        done = placed.filter("side = 1").join(small(totals.select("vm", "vd", "add_leaves", "add_saved")), ["vm", "vd"])
        sums = {"n_leaves": F.col("acc_leaves") + F.col("add_leaves"), "saved_tokens": F.col("acc_saved") + F.col("add_saved")}
        parts.append(written(done.select(*NODE, *[e.alias(k) for k, e in sums.items()]), "centroids"))
        ways = paths.select(F.col("c").alias("vm"), F.col("d").alias("nd"), F.col("m").alias("nm"))
        ways = small(totals).join(ways, "vm").filter((F.col("nd") < F.col("vd")) & (F.col("nd") >= F.col("of_d")))
        ways = written(ways.select("nm", "nd", F.col("v_under").alias("way_under"), F.col("add_leaves").alias("way_leaves"), F.col("add_saved").alias("way_saved")), "ways")
        rest = placed.filter("side <> 1").join(small(ways), (F.col("m") == F.col("nm")) & (F.col("d") == F.col("nd")), "left")
        below = F.col("side") == 2
        state = written(rest.select(
            *NODE, "up", (F.col("under") - F.coalesce("way_under", zero)).alias("under"), "leaf", "saved",
            (F.col("acc_leaves") + F.coalesce("way_leaves", zero)).alias("acc_leaves"), (F.col("acc_saved") + F.coalesce("way_saved", zero)).alias("acc_saved"),
            F.when(below, F.col("child")).otherwise(F.col("top_m")).alias("top_m"), F.when(below, F.col("vd") + 1).otherwise(F.col("top_d")).alias("top_d"),
        ), "components")
        drop_written(large)
    whole = parts[0].select(out)
    for part in parts[1:]:
        whole = whole.union(part.select(out))
    return whole


def _end_hashes(ends: DataFrame) -> DataFrame:
    """(m, d, ends): SHA-256 of the numbers ``c`` of each node, ascending, comma-joined. The numbers are sorted over ranges and
    joined to pieces there; one task then reads a node's pieces in order and holds no more than a batch of them."""
    n = max(1, -(-ends.count() // ROWS_PER_RANGE))
    ranged = ends.repartitionByRange(n, *NODE, "c").sortWithinPartitions(*NODE, "c")

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, first, held, size = None, None, [], 0
        for batch in batches:
            rows = []
            for m, d, c in zip(*(batch.column(k).to_pylist() for k in ("m", "d", "c")), strict=True):
                if (m, d) != here or size >= PIECE:
                    if held:
                        rows.append((*here, first, ",".join(held)))
                    here, first, held, size = (m, d), c, [], 0
                held.append(str(c))
                size += len(held[-1]) + 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], ["m", "d", "c", "piece"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*here, first, ",".join(held))], ["m", "d", "c", "piece"])

    pieces = ranged.mapInArrow(join, "m long, d long, c long, piece string")

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, state = None, None
        for batch in batches:
            rows = []
            for m, d, piece in zip(*(batch.column(k).to_pylist() for k in ("m", "d", "piece")), strict=True):
                if (m, d) == here:
                    state.update(b"," + piece.encode())
                    continue
                if here:
                    rows.append((*here, state.hexdigest()))
                here, state = (m, d), hashlib.sha256(piece.encode())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], ["m", "d", "ends"])
        if here:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*here, state.hexdigest())], ["m", "d", "ends"])

    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "c").mapInArrow(digest, "m long, d long, ends string")


@tidy
def prefix_trie(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    group: int = GROUP, heads: int = HEADS, block: int = BLOCK, turns_held: int = TURNS,
) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) for each node of the trie.

    Conversation ``c`` begins with the first h turns of conversation ``c - c % group``, h being crc32 of its number modulo ``heads``,
    and goes on with its own turns behind its first h. Turns are ordered by turn, null first; turns that share a place by
    role and text, and turns that repeat a row stand one behind the other. Null roles and texts are empty. Rows with a null
    number take no part. A table without numbered rows has no node. Other columns aren't read.
    """
    turns = _turns(conversations, conv_id, turn, role, text)
    rebuilt = _rebuilt(turns, group, heads)
    rows = written(_prefixes(rebuilt, turns_held), "prefixes")
    key = ["d", "x1", "x2"]
    grouped = rows.groupBy(*key).agg(
        F.min("c").alias("m"), F.count("*").alias("n_convs"), F.max("bytes").alias("node_bytes"), F.sum(F.col("len") - F.col("d") + 1).alias("under"),
    )
    grouped = written(grouped, "nodes")
    members = written(rows.select("c", "len", *key).join(small(grouped), key).drop("x1", "x2"), "members")
    naming = members.filter((F.col("d") == F.col("len")) & (F.col("m") == F.col("c"))).select("c")
    paths = members.select("c", "d", "m").join(small(written(naming, "naming")), "c", "left_semi")
    above = paths.select("c", (F.col("d") + 1).alias("d"), F.col("m").alias("up"))
    paths = written(paths.join(above, ["c", "d"], "left"), "paths")
    nodes = members.filter("m = c").join(paths.select("c", "d", "up"), ["c", "d"]).select(*NODE, "up", "under", "n_convs", "node_bytes")
    nodes = written(nodes, "tree")
    counts = nodes.filter("up is not null").groupBy(F.col("up").alias("m"), (F.col("d") - 1).alias("d")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(small(counts), NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    saved = (F.col("n_convs") - 1) * F.col("node_bytes")
    nodes = written(nodes.withColumns({"leaf": (F.col("n_children") == 0).cast("long"), "saved": saved}), "tree")
    sums = roll_up(nodes.select(*NODE, "up", "under", "leaf", "saved"), paths, block)
    ends = written(_end_hashes(members.filter(F.col("d") == F.col("len")).select(*NODE, "c")), "ends")
    found = nodes.join(sums, NODE).join(ends, NODE, "left")
    return found.select(
        F.col("m").alias("conv_id"), F.col("d").alias("depth"), F.col("up").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
