"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts come from every labelled text: each task adds up its own texts and hands on one row per
label and bucket, Spark sums those. The log-probability matrix (labels x buckets, its size checked)
is broadcast; texts are scored in batches by gathering its entries and summing them per text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urlsift.llm.common import packed, span_sums

ORDERS = 3
BUCKET_BITS = 16
SMOOTHING = 0.1
UNDETERMINED = "und"
#: A wider matrix is refused before it is broadcast.
MAX_MATRIX_BYTES = 512 << 20
#: A task hands its counts on when it holds more labels than this.
LABELS_HELD = 64

_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def buckets(codes: np.ndarray, orders: int, bits: int) -> Iterator[np.ndarray]:
    """For each order from 1 the bucket of the n-gram at each position but the last ``orders - 1``."""
    n = len(codes) - orders + 1
    wide = codes.astype(np.uint64)
    h = wide[:n]
    for k in range(orders):
        if k:
            h = h * _STEP + wide[k : k + n]
        mixed = (h + np.uint64(k + 1)) * _MIX
        yield ((mixed ^ (mixed >> np.uint64(32))) * _STEP >> np.uint64(64 - bits)).astype(np.int64)


def _counts(texts: list[str], orders: int, bits: int) -> np.ndarray:
    total = np.zeros(1 << bits, np.int64)
    for codes, begin, end, _ in packed(texts, orders - 1, str.lower):
        inside = np.zeros(len(codes) - orders + 2, np.int64)
        np.add.at(inside, begin, 1)
        np.add.at(inside, end, -1)
        keep = np.cumsum(inside[:-1]) > 0
        for found in buckets(codes, orders, bits):
            total += np.bincount(found[keep], minlength=1 << bits)
    return total


@dataclass(frozen=True)
class LanguageModel:
    """Labels in code point order, log prior, and log P(bucket | label) by label."""

    labels: tuple[str, ...]
    prior: np.ndarray
    table: np.ndarray
    orders: int
    bits: int

    def scores(self, texts: list[str]) -> np.ndarray:
        """Log joint of each text (rows) and label (columns)."""
        joint = np.tile(self.prior, (len(texts), 1))
        for codes, begin, end, owner in packed(texts, self.orders - 1, str.lower):
            found = list(buckets(codes, self.orders, self.bits))
            for j in range(len(self.labels)):
                sums = self.table[j][found[0]]
                for more in found[1:]:
                    sums += self.table[j][more]
                np.add.at(joint[:, j], owner, span_sums(sums, begin, end))
        return joint

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Label and posterior; ``und`` with 0.0 for a null, a text without a letter, or an empty model."""
        known = [i for i, t in enumerate(texts) if t and self.labels and any(map(str.isalpha, t))]
        labels, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if known:
            joint = self.scores([texts[i] for i in known])
            best = joint.argmax(axis=1)
            top = joint[np.arange(len(known)), best]
            score[known] = 1 / np.exp(joint - top[:, None]).sum(axis=1)
            for i, j in zip(known, best, strict=True):
                labels[i] = self.labels[j]
        return labels, score


def fit_languages(
    docs: DataFrame, text: Column, label: Column, orders: int = ORDERS, bits: int = BUCKET_BITS, smoothing: float = SMOOTHING
) -> LanguageModel:
    """Count every text with a label. Rows whose text or label is null are passed over; repeated rows
    count each time; no labelled row gives a model that answers ``und``. Other columns aren't read."""
    rows = docs.select(text.cast("string").alias("t"), label.cast("string").alias("l")).filter("t is not null and l is not null")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def out():
            for name, (seen, total) in held.items():
                at = np.flatnonzero(total)
                ids = np.append(at, -1).astype(np.int32)  # -1: the number of texts
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(ids)), pa.array(ids), pa.array(np.append(total[at], seen))], ["l", "bucket", "n"]
                )

        for batch in batches:
            own: dict[str, list[str]] = {}
            for t, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own.setdefault(name, []).append(t)
            for name, texts in own.items():
                entry = held.setdefault(name, [0, np.zeros(1 << bits, np.int64)])
                entry[0] += len(texts)
                entry[1] += _counts(texts, orders, bits)
                if len(held) > LABELS_HELD:
                    yield from out()
                    held.clear()
        yield from out()

    sums = rows.mapInArrow(count, "l string, bucket int, n long").groupBy("l", "bucket").agg(F.sum("n").alias("n"))
    n_labels = docs.select(label.alias("l")).distinct().count()
    if n_labels * (8 << bits) > MAX_MATRIX_BYTES:
        raise ValueError(f"{n_labels} labels of {1 << bits} buckets exceed {MAX_MATRIX_BYTES} bytes; use fewer bits")
    found = sums.toArrow()
    labels = sorted(set(found.column("l").to_pylist()))
    place = {name: j for j, name in enumerate(labels)}
    table, seen = np.zeros((len(labels), 1 << bits)), np.zeros(len(labels))
    if found.num_rows:
        rank = np.array([place[x] for x in found.column("l").to_pylist()])
        at, n = found.column("bucket").to_numpy(), found.column("n").to_numpy()
        texts = at < 0
        seen[rank[texts]] = n[texts]
        table[rank[~texts], at[~texts]] = n[~texts]
    table = np.log(table + smoothing) - np.log(table.sum(axis=1, keepdims=True) + smoothing * (1 << bits))
    return LanguageModel(tuple(labels), np.log(np.maximum(seen, 1) / max(seen.sum(), 1)), table, orders, bits)


def language(spark: SparkSession, model: LanguageModel, text: Column) -> Column:
    """Column of struct<lang_pred string, score double> for each whole text, by the broadcast model.
    ``und`` with score 0 where the text is null, has no letter, or nothing was learned."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predict(texts: pa.Array) -> pa.Array:
        labels, score = shared.value.predict(texts.to_pylist())
        return pa.StructArray.from_arrays([pa.array(labels, pa.string()), pa.array(score)], ["lang_pred", "score"])

    return predict(text)
