"""Exact nearest neighbours over blocks of references, pruned by their boxes.

A tree of cuts, made from some references, deals references and queries to cells. A task cuts what it holds of neighbouring cells
further, each time across the widest component, into blocks of references and groups of queries. Each knows its box: the least and
greatest value of every component. No row of a box is nearer to another box than the gap between them, and none is farther than
their far sides. So a group reads the blocks first that are sure to hold k rows near its middle; the k-th of these is a limit for each
query, and only blocks whose box reaches into the limits of a group are sent to the group's stack. A stack asks for
the blocks near its own box before it looks at its groups, so no query is held against all blocks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urlsift.operators.distances import LISTS, NEIGHBOURS, Nearest
from urlsift.runtime import drop_written, small, written

#: Rows of a cell, cells, and bytes of the rows from which the tree is made. The choice decides the speed alone.
CELL_ROWS = 4_096
CELLS = 4_096
TREE_BYTES = 16 << 20
#: Queries of a stack, and of more components than ``FEW``, where stacks need most blocks and larger ones have fewer sent; and groups of a stack, whose
#: marks are the bits of a long.
QUERY_ROWS = 4_096
WIDE_ROWS = 16_384
FEW = 4
GROUPS = 64
#: Bytes of the blocks' boxes, which every task gets: blocks grow rather than these.
RANGE_BYTES = 16 << 20
#: Bytes of vectors that a task cuts into blocks at a time, and of the blocks it hands on at a time.
CHUNK_BYTES = 8 << 20
SENT_BYTES = 4 << 20
#: Gaps are computed with rounding; they are loosened by this part of them.
SLACK = 1e-9


@dataclass
class Tree:
    """Cuts: a node sends rows whose component ``dim`` is above ``cut`` to its second child. ``cell`` is a leaf's number, else -1."""

    dim: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    cell: np.ndarray

    def place(self, v: np.ndarray) -> np.ndarray:
        node, at = np.zeros(len(v), np.int64), np.arange(len(v))
        while len(at := at[self.cell[node[at]] < 0]):
            here = node[at]
            node[at] = self.child[here, (v[at, self.dim[here]] > self.cut[here]).astype(np.int64)]
        return self.cell[node]


def tree_of(rows: np.ndarray, leaf: int) -> Tree:
    """A tree whose leaves hold at most ``leaf`` of the rows, unless these are equal; leaves are numbered from first to last."""
    nodes: list[list] = []
    cells = 0

    def grow(part: np.ndarray) -> int:
        nonlocal cells
        me = len(nodes)
        nodes.append([0, np.float32(0), (0, 0), -1])
        spread = part.max(axis=0).astype(np.float64) - part.min(axis=0)
        j = int(spread.argmax())
        if len(part) <= leaf or not spread[j] > 0:
            nodes[me][3] = cells
            cells += 1
            return me
        x = part[:, j]
        cut = np.partition(x, len(x) // 2)[len(x) // 2]
        if not (x > cut).any():
            cut = x[x < cut].max()
        above = x > cut
        nodes[me][:3] = j, cut, (grow(part[~above]), grow(part[above]))
        return me

    grow(rows)
    dim, cut, child, cell = zip(*nodes, strict=True)
    return Tree(np.array(dim), np.array(cut, np.float32), np.array(child), np.array(cell, np.int32))


def runs(v: np.ndarray, size: int) -> list[np.ndarray]:
    """Places of the rows, in runs of at most ``size`` rows that lie together. Equal rows stay in their order."""
    todo, out = [np.arange(len(v))], []
    while todo:
        at = todo.pop()
        if len(at) <= size:
            out.append(at)
            continue
        part = v[at]
        spread = part.max(axis=0).astype(np.float64) - part.min(axis=0)
        half = -(-len(at) // size) // 2 * size
        if spread.max() > 0:
            at = at[np.argpartition(part[:, spread.argmax()], half)]
        todo += [at[half:], at[:half]]
    return out


def _raised(gap: np.ndarray, power: int) -> np.ndarray:
    return gap if power == 1 else gap * gap if power == 2 else gap**power


@dataclass
class Ranges:
    """Of each block its number, rows and box. Distances here are powered."""

    power: int
    at: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def least(self, low: np.ndarray, high: np.ndarray, of=slice(None)) -> np.ndarray:
        """For each box and each block of ``of``: a distance that no two of their rows fall below."""
        total = 0.0
        for j in range(self.low.shape[1]):
            gap = np.maximum(self.low[None, of, j] - high[:, j, None], low[:, j, None] - self.high[None, of, j])
            total = total + _raised(np.maximum(gap, 0, out=gap), self.power)
        return total * (1 - SLACK)

    def most(self, low: np.ndarray, high: np.ndarray, of=slice(None)) -> np.ndarray:
        """For each box and each block of ``of``: a distance that no two of their rows pass."""
        total = 0.0
        for j in range(self.low.shape[1]):
            gap = np.maximum(self.high[None, of, j] - low[:, j, None], high[:, j, None] - self.low[None, of, j])
            total = total + _raised(gap, self.power)
        return total * (1 + SLACK)

    def first(self, low: np.ndarray, high: np.ndarray, k: int) -> np.ndarray:
        """For each group (its box) of a stack and each block: whether it is read first. A group's blocks hold k rows at least, if there are as many."""
        box = low.min(axis=0)[None], high.max(axis=0)[None]
        most = self.most(*box)[0]
        order = np.argsort(most, kind="stable")
        enough = min(np.searchsorted(np.cumsum(self.rows[order]), k), len(order) - 1)
        # blocks that are surely within this distance of the whole stack hold k rows, so no group's first ones lie beyond it
        near = np.flatnonzero(self.least(*box)[0] <= most[order[enough]])
        middle = (low + high) / 2
        most = self.most(middle, middle, near)
        take = min(k, len(near))
        best = np.argpartition(most, take - 1, axis=1)[:, :take]
        best = np.take_along_axis(best, np.argsort(np.take_along_axis(most, best, axis=1), axis=1, kind="stable"), axis=1)
        before = np.cumsum(self.rows[near[best]], axis=1) - self.rows[near[best]]
        chosen = np.zeros((len(low), len(self.at)), bool)
        np.put_along_axis(chosen, near[best], before < k, axis=1)
        return chosen

    def others(self, low: np.ndarray, high: np.ndarray, limits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Blocks that were not read first and reach into the limit of some group, nearest first, and for each group and each of these whether they do."""
        near = np.flatnonzero(self.least(low.min(axis=0)[None], high.max(axis=0)[None])[0] <= limits.max())
        least = self.least(low, high, near)
        need = (least <= limits[:, None]) & ~self.first(low, high, k)[:, near]
        order = np.argsort(np.where(need, least, np.inf).min(axis=0), kind="stable")
        order = order[need.any(axis=0)[order]]
        return near[order], need[:, order]


def _vectors(column, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, width)


def _chosen_tree(refs: DataFrame, width: int, n_refs: int) -> Tree:
    cells = min(CELLS, max(1, n_refs // CELL_ROWS))
    rows = min(64 * cells, max(cells, TREE_BYTES // (4 * width)))
    some = refs.select("vector")
    some = some.sample(min(1.0, rows / n_refs), seed=42).limit(2 * rows) if rows < n_refs else some
    found = _vectors(some.toArrow().column(0), width)
    return tree_of(found if len(found) else _vectors(refs.select("vector").limit(1).toArrow().column(0), width), max(1, rows // cells))


def _placed(df: DataFrame, tree: Tree, width: int) -> DataFrame:
    """Add the cell."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = tree.place(_vectors(batch.column(batch.schema.get_field_index("vector")), width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])

    return df.mapInArrow(place, T.StructType([*df.schema.fields, T.StructField("cell", T.IntegerType())]))


def _stacked(df: DataFrame, size: int, group: int, tie: str, count: int, width: int) -> DataFrame:
    """(at, ids, labels, vectors, low, high, n): rows of neighbouring cells, up to ``size`` together, in runs of ``group``. Rows are
    spread over ranges of the cells and ``tie``, so a cell may have any size."""
    chunk = max(size, CHUNK_BYTES // (4 * width))
    parts = max(1, min(-(-count // (4 * size)), -(-count // 16_384)))
    ranged = df.repartitionByRange(parts, "cell", tie) if parts > 1 else df.repartition(1)
    names = ["ids", "labels", "vectors", "low", "high", "n"]

    def stack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def cut():
            ids, labels, v = (np.concatenate(x) for x in zip(*held, strict=True))
            out, sent = [], 0
            for at in runs(v, size):
                if group < size:
                    at = at[np.concatenate(runs(v[at], group))]
                part = v[at]
                out.append((ids[at].tobytes(), labels[at].tobytes(), part.tobytes(), part.min(axis=0).tobytes(), part.max(axis=0).tobytes(), len(at)))
                sent += part.nbytes
                if sent > SENT_BYTES:
                    yield batch_of(out)
                    out, sent = [], 0
            if out:
                yield batch_of(out)

        def batch_of(out):
            columns = list(zip(*out, strict=True))
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.binary()) for c in columns[:5]), pa.array(columns[5], pa.int32())], names)

        n = 0
        for batch in batches:
            for a in range(0, batch.num_rows, chunk):
                part = batch.slice(a, chunk)
                held.append((part.column(0).to_numpy(zero_copy_only=False).astype(np.int64), part.column(1).to_numpy(zero_copy_only=False).astype(np.int32), _vectors(part.column(2), width)))
                n += part.num_rows
                if n >= chunk:
                    yield from cut()
                    held, n = [], 0
        if held:
            yield from cut()

    ordered = ranged.sortWithinPartitions("cell", tie).select(tie, F.coalesce("label", F.lit(-1)).alias("label"), "vector")
    rows = ordered.mapInArrow(stack, "ids binary, labels binary, vectors binary, low binary, high binary, n int")
    return rows.withColumn("at", F.monotonically_increasing_id())


def _ranges(blocks: DataFrame, power: int) -> Ranges:
    rows = blocks.select("at", "n", "low", "high").orderBy("at").toArrow()
    ends = [np.array([np.frombuffer(x.as_buffer(), np.float32) for x in rows.column(c)], np.float64) for c in ("low", "high")]
    return Ranges(power, rows.column("at").to_numpy(), rows.column("n").to_numpy().astype(np.int64), *ends)


def stack_rows(width: int) -> int:
    return QUERY_ROWS if width <= FEW else WIDE_ROWS


def _groups(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The boxes of the groups of a stack."""
    starts = np.arange(0, len(v), stack_rows(v.shape[1]) // GROUPS)
    return np.minimum.reduceat(v, starts, axis=0).astype(np.float64), np.maximum.reduceat(v, starts, axis=0).astype(np.float64)


def _bits(marks: np.ndarray) -> np.ndarray:
    """A long for each column of at most 64 rows of marks."""
    powers = np.left_shift(np.uint64(1), np.arange(len(marks), dtype=np.uint64))
    return (marks * powers[:, None]).sum(axis=0, dtype=np.uint64).view(np.int64)


def _wanted(stacks: DataFrame, ranges, k: int, shares: int, limits: bool) -> DataFrame:
    """(stack, share, place, at, block, groups): the blocks that some group of a stack needs, nearest first, dealt over shares, and the groups
    that need them. Without ``limits`` those read first, with them (the k-th distance of each query so far) the others that may hold something nearer."""
    columns = ["at", "vectors", "n", "limits"] if limits else ["at", "vectors", "n"]

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ranges.value
        for batch in batches:
            for row in batch.to_pylist():
                v = np.frombuffer(row["vectors"], np.float32).reshape(row["n"], -1)
                low, high = _groups(v)
                if limits:
                    widest = np.maximum.reduceat(np.frombuffer(row["limits"], np.float64), np.arange(0, row["n"], stack_rows(v.shape[1]) // GROUPS))
                    found, need = known.others(low, high, widest, k)
                else:
                    need = known.first(low, high, k)
                    found = np.flatnonzero(need.any(axis=0))
                    need = need[:, found]
                place = np.arange(len(found), dtype=np.int32)
                cols = [np.full(len(found), row["at"], np.int64), (place % shares).astype(np.int32), place, known.at[found], found.astype(np.int32), _bits(need)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["stack", "share", "place", "at", "block", "groups"])

    return stacks.select(columns).mapInArrow(choose, "stack long, share int, place int, at long, block int, groups long")


def _read(stacks: DataFrame, blocks: DataFrame, pairs: DataFrame, ranges, k: int, power: int, limits: bool) -> DataFrame:
    """(row, neighbours, scored): the k nearest of each query among the blocks its group was given, by powered distance; with ``limits``
    those within its limit."""
    packed = ["ids", "labels", "vectors", "n"]
    limit = F.col("limits") if limits else F.lit(None).cast("binary").alias("limits")
    # Pairs are many in few bytes of files: they are never broadcast
    heads = pairs.select("stack", "share").distinct().hint("merge").join(stacks.withColumnRenamed("at", "stack").select("stack", *packed, limit), "stack")
    heads = heads.select("stack", "share", F.lit(-1).alias("place"), F.lit(-1).alias("block"), F.lit(0).cast("long").alias("groups"), *packed, "limits")
    bodies = pairs.hint("merge").join(blocks.select("at", *packed), "at")
    bodies = bodies.select("stack", "share", "place", "block", "groups", *packed, F.lit(None).cast("binary").alias("limits"))
    streams = heads.union(bodies).repartition("stack", "share").sortWithinPartitions("stack", "share", "place")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rows, asked, best, scored = ranges.value, None, None, None, None

        def out():
            real = np.isfinite(best.dist)
            ends = np.append(0, np.cumsum(real.sum(axis=1))).astype(np.int32)
            flat = pa.StructArray.from_arrays(
                [pa.array(best.ids[real]), pa.array(best.marks[real].astype(np.int32)), pa.array(best.dist[real])], names=["ref_id", "label", "distance"])
            return pa.RecordBatch.from_arrays([pa.array(rows), pa.ListArray.from_arrays(pa.array(ends), flat), pa.array(scored)], ["row", "neighbours", "scored"])

        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(j)[i].as_py() for j, n in enumerate(batch.schema.names)}
                ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int32)
                vectors = np.frombuffer(row["vectors"], np.float32).reshape(row["n"], -1)
                if row["place"] < 0:
                    if rows is not None:
                        yield out()
                    rows, asked, scored = ids, vectors, np.zeros(len(ids), np.int64)
                    best = Nearest(len(ids), k, None if row["limits"] is None else np.frombuffer(row["limits"], np.float64))
                    continue
                groups = np.array([row["groups"]]).view(np.uint64) >> np.arange(64, dtype=np.uint64) & np.uint64(1)
                part = np.flatnonzero(np.repeat(groups.astype(bool), stack_rows(asked.shape[1]) // GROUPS)[: len(asked)])
                point = asked[part].astype(np.float64)
                gap = known.least(point, point, slice(row["block"], row["block"] + 1))[:, 0]
                part = part[gap <= best.bar(part)]
                if len(part):
                    scored[part] += len(ids)
                    best.read(part, asked, vectors, ids, labels, power)
        if rows is not None:
            yield out()

    fields = [T.StructField("row", T.LongType()), T.StructField("neighbours", NEIGHBOURS), T.StructField("scored", T.LongType())]
    return streams.mapInArrow(stream, T.StructType(fields))


def _with_limits(stacks: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """Stacks with the k-th distance of each of their queries; infinite where fewer are known."""
    kth = F.when(F.size("neighbours") >= k, F.element_at("neighbours", k)["distance"])
    rows = found.select(F.col("row"), kth.alias("kth"))
    places = stacks.select("at", "ids").mapInArrow(_members, "at long, row long, place int")
    sorted_rows = places.join(rows.hint("merge"), "row").repartition("at").sortWithinPartitions("at", "place")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held = None, []

        def out():
            values = np.array([np.inf if x is None else x for x in held], np.float64)
            return pa.RecordBatch.from_arrays([pa.array([here]), pa.array([values.tobytes()])], ["at", "limits"])

        for batch in batches:
            for at, kth in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if at != here and held:
                    yield out()
                    held = []
                here = at
                held.append(kth)
        if held:
            yield out()

    return stacks.join(sorted_rows.select("at", "kth").mapInArrow(pack, "at long, limits binary"), "at")


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            rows = np.frombuffer(data.as_buffer(), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(rows), at)), pa.array(rows), pa.array(np.arange(len(rows), dtype=np.int32))], ["at", "row", "place"])


def pruned(
    queries: DataFrame, refs: DataFrame, keys: Sequence[str], width: int, n_refs: int, k: int, power: int, block_rows: int,
) -> DataFrame:
    """The keys, ``neighbours`` and ``scored`` for each row of ``queries`` (keys, vector); ``refs`` (id, label, vector) and query
    vectors have ``width`` finite numbers, and queries without a vector get an empty list."""
    context = queries.sparkSession.sparkContext
    rows = written(queries.withColumn("_row", F.monotonically_increasing_id()), "knn-queries")
    asked = rows.filter("vector is not null").select(F.col("_row").alias("row"), F.lit(None).cast("int").alias("label"), "vector")
    tree = _chosen_tree(refs, width, n_refs)
    size = max(block_rows, -(-n_refs * (16 * width + 16) // RANGE_BYTES))
    blocks = written(_stacked(_placed(refs, tree, width), size, size, "id", n_refs, width), "knn-blocks")
    stacks = written(_stacked(_placed(asked, tree, width), stack_rows(width), stack_rows(width) // GROUPS, "row", asked.count(), width), "knn-stacks")
    ranges = context.broadcast(_ranges(blocks, power))
    shares = max(1, -(-context.defaultParallelism // max(1, stacks.count())))
    first = written(_wanted(stacks, ranges, k, 1, False), "knn-first")
    near = written(_read(stacks, blocks, first, ranges, k, power, False), "knn-near")
    limited = written(_with_limits(stacks, near, k), "knn-limits")
    pairs = written(_wanted(limited, ranges, k, shares, True), "knn-pairs")
    rest = written(_read(limited, blocks, pairs, ranges, k, power, True), "knn-rest")
    # k entries from the first blocks, and from each share, of which there are at most as many as slots
    merged = near.union(rest).groupBy("row").agg(F.flatten(F.collect_list("neighbours")).alias("n"), F.sum("scored").alias("scored"))
    ordered = F.array_sort(F.transform("n", lambda x: F.struct(x["distance"].alias("distance"), x["ref_id"].alias("ref_id"), x["label"].alias("label"))))
    powered = {2: F.sqrt, 1: lambda d: d}.get(power, lambda d: F.pow(d, F.lit(1.0 / power)))
    out = F.transform(F.slice(ordered, 1, k), lambda x: F.struct(x["ref_id"].alias("ref_id"), x["label"].alias("label"), powered(x["distance"]).alias("distance")))
    merged = merged.select("row", out.alias("neighbours"), "scored")
    found = rows.join(small(merged), rows["_row"] == merged["row"], "left")
    none = F.array().cast(LISTS)
    result = written(found.select(*keys, F.coalesce("neighbours", none).alias("neighbours"), F.coalesce("scored", F.lit(0).cast("long")).alias("scored")), "knn")
    for table in (rows, blocks, stacks, first, near, limited, pairs, rest):
        drop_written(table)
    ranges.destroy()
    return result
