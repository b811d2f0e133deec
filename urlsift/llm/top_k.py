"""Exact top-k inner products with block-at-a-time pruning.

Candidates are put in an order that brings similar vectors together and cut into ranges: a group of
blocks is one row that holds its vectors (the forward index) and each block's largest and smallest component
per term. For a query the blocks of a group are ordered by the sum of its terms' best products, an
upper bound of every score inside; blocks are scored in that order until a bound falls below the k-th score.
Groups meet chunks of the stated queries one to one; the best of all groups are merged.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urlsift.llm.common import drop_written, written

BLOCK = 128
GROUP_BLOCKS = 32
CHUNK = 1024
#: Scores beyond these are no longs.
SMALLEST, LARGEST = -(2**63), 2**63 - 1
_LEAST = -(2**63 - 1)
#: Below every key of scores that are Python integers.
_NONE = -(1 << 400)


def quantized(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component as a long; null for a null vector and for one with a null or
    non-finite component. A component whose floor is no long is an error."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))

    def whole(x: Column) -> Column:
        scaled = x.cast("double") * scale
        error = F.raise_error(F.concat(F.lit("component out of the range of a long: "), x.cast("string"))).cast("long")
        return F.when((scaled >= -(2.0**63)) & (scaled < 2.0**63), F.floor(scaled)).otherwise(error)

    return F.when(F.coalesce(good, F.lit(False)), F.transform(vector, whole))


def _matrix(lists: list, width: int) -> np.ndarray:
    out = np.zeros((len(lists), width), np.int64)
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def _stacked(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows (id, vector) as rows (part, n, width, ids, vectors) of up to ``size`` vectors each; missing components are 0."""
    part = TaskContext.get().partitionId() << 32
    ids: list[int] = []
    vectors: list = []

    def out():
        width = max(map(len, vectors))
        row = {"part": [part], "n": [len(ids)], "width": [width], "ids": [np.array(ids, np.int64).tobytes()],
               "vectors": [_matrix(vectors, width).tobytes()]}
        return pa.RecordBatch.from_pydict(row, schema=_STACK)

    for batch in batches:
        for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids.append(i)
            vectors.append(v)
            if len(ids) == size:
                yield out()
                ids, vectors, part = [], [], part + 1
    if ids:
        yield out()


_STACK = pa.schema([("part", pa.int64()), ("n", pa.int32()), ("width", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary())])
_STACK_DDL = "part long, n int, width int, ids binary, vectors binary"


def _numbered(stacks: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Written stacks with a dense number; there is one row per thousands of vectors."""
    stacks = written(stacks, "stacks")
    number = stacks.select("part").withColumn(name, (F.row_number().over(Window.orderBy("part")) - 1).cast("long"))
    return stacks.join(number, "part").drop("part"), stacks.count()


def _unstack(row: dict, at: str) -> tuple[np.ndarray, np.ndarray]:
    n, width = row[f"{at}_n"], row[f"{at}_width"]
    return np.frombuffer(row[f"{at}_ids"], np.int64), np.frombuffer(row[f"{at}_vectors"], np.int64).reshape(n, width)


def search(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, block: int = BLOCK
) -> tuple[list[np.ndarray], list[np.ndarray], int]:
    """For each query the ids and scores of its k best vectors, best first, ties to the smaller id, never of its own
    id; and how many of the (query, block) pairs were scored. A returned score that is no long is an error."""
    width = max(queries.shape[1], vectors.shape[1])
    whole_q = np.pad(queries, ((0, 0), (0, width - queries.shape[1])))
    whole_x = np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))
    q, x = whole_q.astype(np.float64), whole_x.astype(np.float64)
    starts = np.arange(0, len(ids), block)
    most = float(np.abs(q).sum(axis=1).max(initial=0) * np.abs(x).max(initial=0))
    exact = most < 2**49  # scores and their ranks fit into one 64-bit key, and sums of doubles are exact
    if not exact:
        # The bound of a block sums products of maxima and minima, so it is at most twice ``most``, which is rounded.
        kind = np.int64 if most < 2**61 else object
        q, x = whole_q.astype(kind), whole_x.astype(kind)
    top, low = np.maximum.reduceat(x, starts), np.minimum.reduceat(x, starts)
    bound = np.maximum(q, 0) @ top.T + np.minimum(q, 0) @ low.T
    turn = np.argsort(-bound, axis=1, kind="stable")
    # A key is the score and, below it, the place among ascending ids, counted from behind.
    place = np.empty(len(ids), np.int64)
    place[np.argsort(ids, kind="stable")] = np.arange(len(ids))
    bits = max(1, int(len(ids)).bit_length())
    rank = (1 << bits) - 1 - place
    kept = np.full((len(q), k), _LEAST) if exact else np.full((len(q), k), _NONE, dtype=object)
    active, scored = np.arange(len(q)), 0
    for j in range(len(starts)):
        b = turn[active, j]
        if j:
            open_ = bound[active, b] >= (kept[active].min(axis=1) >> bits)
            active, b = active[open_], b[open_]
        if not len(active):
            break
        for number in np.unique(b):
            rows = active[b == number]
            part = slice(starts[number], starts[number] + block)
            score = q[rows] @ x[part].T
            if exact:
                score = score.astype(np.int64)
                keys = (score << bits) + rank[part]
                keys[query_ids[rows][:, None] == ids[part]] = _LEAST
                both = np.concatenate([kept[rows], keys], axis=1)
                kept[rows] = -np.partition(-both, k - 1, axis=1)[:, :k] if both.shape[1] > k else both
            else:
                keys = score.astype(object) * (1 << bits) + rank[part].astype(object)
                keys[query_ids[rows][:, None] == ids[part]] = _NONE
                kept[rows] = np.sort(np.concatenate([kept[rows], keys], axis=1), axis=1)[:, -k:]
            scored += len(rows)
    by_place = np.sort(ids, kind="stable")
    found_ids, found_scores = [], []
    for keys in kept:
        real = np.sort(keys[keys > (_LEAST if exact else _NONE)])[::-1]
        found_ids.append(by_place[((1 << bits) - 1 - (real & ((1 << bits) - 1))).astype(np.int64)])
        best = real >> bits
        if len(best) and not (SMALLEST <= best[-1] and best[0] <= LARGEST):
            raise OverflowError(f"a score of {best[0]} or {best[-1]} is out of the range of a long")
        found_scores.append(best.astype(np.int64))
    return found_ids, found_scores, scored


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best candidates by inner product, all if there are fewer.

    Both frames are (id long, vector array<long>); rows with a null in either column take no part. A candidate with the
    query's id is its own. Rows that repeat a query id ask once, with the smallest vector; rows that repeat a candidate
    are candidates each. Missing components of a shorter vector count as zero. Empty sides give an empty result.
    """
    asks = queries.toDF("id", "vector").dropna().groupBy("id").agg(F.min("vector").alias("vector"))
    rows = candidates.toDF("id", "vector").dropna()
    n, n_asks = rows.count(), asks.count()
    size = F.transform("vector", F.abs)
    lead = F.array_position(size, F.array_max(size))
    lead = F.coalesce(lead * F.signum(F.get("vector", (lead - 1).cast("int"))), F.lit(0.0))
    ordered = rows.withColumn("lead", lead).repartitionByRange(max(1, -(-n // (BLOCK * GROUP_BLOCKS))), "lead", "id")
    ordered = ordered.sortWithinPartitions("lead", "id").select("id", "vector")
    groups, n_groups = _numbered(ordered.mapInArrow(lambda b: _stacked(b, BLOCK * GROUP_BLOCKS), _STACK_DDL), "group")
    asked = asks.repartition(max(1, -(-n_asks // CHUNK))).mapInArrow(lambda b: _stacked(b, CHUNK), _STACK_DDL)
    chunks, n_chunks = _numbered(asked, "chunk")
    fields = ("n", "width", "ids", "vectors")
    left = groups.select("group", *[F.col(c).alias(f"x_{c}") for c in fields], F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("chunk")) if n_chunks else groups.limit(0)
    if not n_groups or not n_chunks:
        return queries.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    right = chunks.select("chunk", *[F.col(c).alias(f"q_{c}") for c in fields], F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))).alias("group"))
    pairs = left.join(right.hint("merge"), ["group", "chunk"]).select(*[f"{at}_{c}" for at in "qx" for c in fields])

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
                (qi, q), (xi, x) = _unstack(row, "q"), _unstack(row, "x")
                ids, scores, _ = search(qi, q, xi, x, k)
                found = {"query_id": qi, "vec_ids": [a.tolist() for a in ids], "scores": [a.tolist() for a in scores]}
                yield pa.RecordBatch.from_pydict(found, schema=pa.schema([("query_id", pa.int64()), ("vec_ids", pa.list_(pa.int64())), ("scores", pa.list_(pa.int64()))]))

    best = written(pairs.mapInArrow(scored, "query_id long, vec_ids array<long>, scores array<long>"), "block-bests")
    drop_written(groups)
    drop_written(chunks)
    each = best.select("query_id", F.explode(F.arrays_zip("vec_ids", "scores")).alias("x")).select(
        "query_id", F.col("x.vec_ids").alias("vec_id"), F.col("x.scores").alias("score")
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
