"""Exact k nearest neighbours.

A reference set of bounded bytes is sent to every task and each Arrow batch of queries is answered by one matrix
product. A larger reference set is packed into blocks, of which a query reads only those that
their boxes don't rule out. Both give the k smallest by (distance, reference id).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urlsift import constants as K
from urlsift.operators.boxes import pruned
from urlsift.operators.distances import NEIGHBOURS, nearest_rows, root

METRICS = ("euclidean", "manhattan", "minkowski")
# Bytes of references that are carried to every task.
REFERENCE_BYTES = 32 << 20
BLOCK_ROWS = 1_000
_CHUNK = 512


def check_parameters(k: int, metric: str = "euclidean", p: int = 1) -> None:
    if isinstance(k, bool) or not isinstance(k, int) or k < 1:
        raise ValueError("k must be a whole number of at least 1")
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    if isinstance(p, bool) or not isinstance(p, int) or p < 1:
        raise ValueError("p must be a whole number of at least 1")


def reference_set(df: DataFrame, order: Sequence[str], rows: int = K.KNN_REFERENCE_ROWS) -> DataFrame:
    """The first rows in key order, labels with their vectors. The classifiers don't use it: all training rows are their references."""
    return df.orderBy(*order).limit(rows)


def _power(metric: str, p: int) -> int:
    return {"euclidean": 2, "manhattan": 1}.get(metric, p)


def _matrix(column, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, width)


def _lists(ids, labels, found, dist, valid) -> pa.Array:
    """A list for each row, empty where the row isn't valid."""
    k = found.shape[1]
    flat = pa.StructArray.from_arrays(
        [
            pa.array(ids[found].ravel(), pa.int64()),
            pa.array(labels[found].ravel(), pa.int32()),
            pa.array(dist.ravel(), pa.float64()),
        ],
        names=["ref_id", "label", "distance"],
    )
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(valid) * k), pa.int32()), flat)


def _bounded(queries, table, keys, width, k, power):
    """Answer from a reference set carried to every task."""
    ids = table.column(0).to_numpy()
    labels = table.column(1).fill_null(-1).to_numpy().astype(np.int32)
    carried = queries.sparkSession.sparkContext.broadcast((ids, labels, _matrix(table.column(2), width)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, ref = carried.value
        for batch in batches:
            for start in range(0, batch.num_rows, _CHUNK):
                part = batch.slice(start, _CHUNK)
                q = _matrix(part.column(part.schema.get_field_index("vector")).drop_null(), width)
                if len(q):
                    found, dist = nearest_rows(q, ref, ids, k, power)
                else:
                    found, dist = np.zeros((0, 1), np.int64), np.zeros((0, 1))
                valid = part.column(part.schema.get_field_index("vector")).is_valid()
                cols = [part.column(part.schema.get_field_index(c)) for c in keys]
                cols.append(_lists(ids, labels, found, root(dist, power), valid.to_numpy(zero_copy_only=False)))
                yield pa.RecordBatch.from_arrays(cols, names=[*keys, "neighbours"])

    fields = [queries.schema[c] for c in keys] + [T.StructField("neighbours", NEIGHBOURS)]
    return queries.mapInArrow(run, T.StructType(fields))


def usable(vector: str) -> Column:
    """The vector if it holds numbers alone; NULL for NULL and for vectors with a NULL, NaN or infinite component."""
    v = F.col(vector)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~odd, v)


def _size(known: DataFrame):
    return known.agg(F.count("*").alias("n"), F.min(F.size("vector")).alias("least"), F.max(F.size("vector")).alias("width")).first()


def _bytes(size) -> int:
    return size["n"] * (4 * (size["width"] or 0) + 12)


def is_carried(refs: DataFrame, vector: str = "features") -> bool:
    """Whether ``nearest`` carries these references to every task, so that queries are answered row by row."""
    return _bytes(_size(refs.select(usable(vector).alias("vector")).filter("vector is not null"))) <= REFERENCE_BYTES


def nearest(
    queries: DataFrame, refs: DataFrame, *, keys: Sequence[str], ref_id: str = "id",
    vector: str = "features", label: str = "label", k: int = K.KNN_K, metric: str = "euclidean",
    p: int = 1, bound: int | None = None, block_rows: int = BLOCK_ROWS, scored: bool = False,
) -> DataFrame:
    """Keys and an array of the k nearest references, nearest first; one row for each query row.

    References of at most ``bound`` bytes (``REFERENCE_BYTES``) are carried to every task; of others a query reads the blocks that boxes don't
    rule out. With ``scored`` a column of that name tells with how many references a query was compared.

    A vector that is NULL or holds a NULL, NaN or infinity is no reference, and as a query gets an empty list. Vectors of unequal
    lengths are an error, as is a reference set without a usable vector.
    """
    check_parameters(k, metric, p)
    power = _power(metric, p)
    bound = REFERENCE_BYTES if bound is None else bound
    known = refs.select(F.col(ref_id).cast("long").alias("id"), F.col(label).cast("int").alias("label"), usable(vector).alias("vector"))
    known = known.filter("vector is not null")
    asked = queries.select(*keys, usable(vector).alias("vector"))
    size = _size(known)
    if not size["n"]:
        raise ValueError("the reference set is empty")
    if size["least"] != size["width"]:
        raise ValueError(f"reference vectors have {size['least']} to {size['width']} components")
    width = F.when(F.size("vector") == size["width"], F.col("vector")).when(
        F.col("vector").isNotNull(), F.raise_error(F.format_string("a query vector has %d components, the references have %d", F.size("vector"), F.lit(size["width"]))))
    asked = asked.withColumn("vector", width)
    if _bytes(size) <= bound:
        found = _bounded(asked, known.toArrow(), list(keys), size["width"], k, power)
        return found.withColumn("scored", F.when(F.size("neighbours") > 0, F.lit(size["n"])).otherwise(F.lit(0)).cast("long")) if scored else found
    found = pruned(asked, known, list(keys), size["width"], size["n"], k, power, block_rows)
    return found if scored else found.drop("scored")


def vote(neighbours: Column, ties: str = "nearest") -> Column:
    """Most common label. A tie goes to the nearest tied neighbour or the lowest label."""
    if ties not in ("nearest", "lowest"):
        raise ValueError("ties must be 'nearest' or 'lowest'")
    labels = F.transform(neighbours, lambda n: n["label"])

    def ballot(y):
        tie = F.array_position(labels, y) if ties == "nearest" else y.cast("long")
        return F.struct(
            F.size(F.filter(labels, lambda x: x == y)).alias("votes"), (-tie).alias("tie"), y.alias("label")
        )

    return F.array_max(F.transform(F.array_distinct(labels), ballot))["label"]


def phishing_share(neighbours: Column) -> Column:
    """Share of the neighbours whose label is 0; NULL without neighbours."""
    return F.try_divide(F.size(F.filter(neighbours, lambda n: n["label"] == 0)).cast("double"), F.size(neighbours))
