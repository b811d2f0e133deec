"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its hashed words and character n-grams (which may touch a word's
edges but not cross them); softmax over a linear map of the average gives the label. It is trained by stochastic
gradient descent in numpy on a bounded sample of labelled documents, each with all its buckets. As the output is linear in
the average, scoring needs one learned number per bucket, averaged over the text.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urlsift.llm.common import packed, span_sums, written
from urlsift.llm.language_id import buckets

BITS = 17
ORDERS = 4
#: Labelled documents that training takes at most, chosen by a hash of the id.
MAX_DOCUMENTS = 4096
DIMENSIONS = 16
EPOCHS = 8
RATE = 0.5

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def features(codes: np.ndarray, begin: np.ndarray, end: np.ndarray):
    """Pairs (bucket, counts) over the positions of a pack: the word that starts at a position, and the
    n-grams of 2 to 4 code points without white space inside."""
    n = len(codes) - ORDERS + 1
    blank = codes <= 32
    inside = np.zeros(n + 1, np.int8)
    inside[begin] += 1
    np.add.at(inside, end, -1)
    inside = np.cumsum(inside[:n]) > 0
    for k, found in enumerate(buckets(codes, ORDERS, BITS)):
        if not k:
            continue
        valid = inside & ~(blank[:n] & blank[k : k + n])
        for mid in range(1, k):
            valid &= ~blank[mid : mid + n]
        yield found, valid
    # Words by prefix sums of a polynomial hash: (sum to the end - sum to the start) / step ** start.
    step = _powers(_STEP, len(codes) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * step[:-1], dtype=np.uint64)])
    word = inside & ~blank[:n]
    first = word.copy()
    first[1:] &= ~word[:-1]
    first[begin[begin < n]] = word[begin[begin < n]]
    starts = np.flatnonzero(first)
    stop = np.flatnonzero(np.append(word[:-1] & (~word[1:] | first[1:]), word[-1:])) + 1
    back = _powers(_BACK, len(codes) + 1)
    h = (sums[stop] - sums[starts]) * back[starts]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    found = np.zeros(n, np.int64)
    found[starts] = (h >> np.uint64(64 - BITS)).astype(np.int64)
    yield found, first


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and how often each occurs."""
    total = np.zeros(1 << BITS, np.int64)
    for codes, begin, end, _ in packed([text], ORDERS - 1):
        for found, valid in features(codes, begin, end):
            total += np.bincount(found[valid], minlength=1 << BITS)
    at = np.flatnonzero(total)
    return at, total[at]


class Bags(Sequence):
    """(buckets, counts, label) of documents from (id, label, bytes of the buckets and counts), by id, then label, then bytes.
    The bytes wait in an unnamed file of the driver, so memory holds one document at a time."""

    def __init__(self, rows: Iterable[tuple]):
        self._file, places = tempfile.TemporaryFile(), []
        for key, label, data in rows:
            places.append((key, int(label), hashlib.sha256(data).digest(), self._file.tell(), len(data)))
            self._file.write(data)
        self._places = sorted(places, key=lambda p: p[:3])

    def __len__(self) -> int:
        return len(self._places)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray, int]:
        _, label, _, at, size = self._places[i]
        self._file.seek(at)
        found, counts = np.frombuffer(self._file.read(size), np.int32).reshape(2, -1)
        return found.astype(np.int64), counts.astype(np.int64), label

    def close(self) -> None:
        self._file.close()


@dataclass(frozen=True)
class QualityModel:
    """``logit`` of each bucket and ``bias``: log odds of label 1 are the bias plus the average over the text."""

    logit: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for codes, begin, end, owner in packed([t or "" for t in texts], ORDERS - 1):
            values, seen = np.zeros(len(codes) - ORDERS + 1), np.zeros(len(codes) - ORDERS + 1)
            for found, valid in features(codes, begin, end):
                values += np.where(valid, self.logit[found], 0)
                seen += valid
            np.add.at(total, owner, span_sums(values, begin, end))
            np.add.at(count, owner, span_sums(seen, begin, end))
        return 1 / (1 + np.exp(-np.clip(self.bias + total / np.maximum(count, 1), -500, 500)))


def train(bags: Sequence[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, rate: float = RATE, seed: int = 1) -> QualityModel:
    """Stochastic gradient descent over (buckets, counts, label 0 or 1). Without documents every score is 1/2. Buckets of no
    document add nothing to a score."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << BITS, DIMENSIONS))
    output, bias = np.zeros((2, DIMENSIONS)), np.zeros(2)
    trained = np.zeros(1 << BITS, bool)
    steps = max(1, epochs * len(bags))
    for step in range(epochs * len(bags)):
        if step % len(bags) == 0:
            order = rng.permutation(len(bags))
        at, counts, label = bags[order[step % len(bags)]]
        speed = rate * (1 - step / steps)
        if not len(at):
            continue
        trained[at] = True
        weight = counts / counts.sum()
        mean = weight @ vectors[at]
        raw = output @ mean + bias
        p = np.exp(raw - raw.max())
        error = p / p.sum()
        error[label] -= 1
        pull = output.T @ error
        output -= speed * np.outer(error, mean)
        bias -= 0.1 * speed * error
        # A bucket moves by its share of the document, relative to the largest.
        vectors[at] -= speed * np.outer(weight / np.linalg.norm(weight), pull)
    difference = output[1] - output[0]
    return QualityModel(np.where(trained, vectors @ difference, 0), float(bias[1] - bias[0]))


def fit_quality(docs: DataFrame, labels: DataFrame, max_documents: int = MAX_DOCUMENTS) -> QualityModel:
    """``docs`` (id, text) and ``labels`` (id, 0 or 1). Takes at most ``max_documents`` labelled ids, those of smallest hash, and
    of their rows at most as many, first one of each id, then those of smallest hash; and of each row all buckets. Rows with
    a null are passed over; rows that repeat a label, or an id and its text, count once."""
    chosen = labels.toDF("id", "label").dropna().filter("label in (0, 1)").distinct()
    chosen = written(chosen.orderBy(F.xxhash64("id"), "id", "label").limit(max_documents), "labels")
    known = docs.toDF("id", "text").dropna().join(F.broadcast(chosen.select("id").distinct()), "id", "left_semi")
    known = known.withColumn("key", F.sha2(F.col("text").cast("binary"), 256))
    texts = written(known.select("id", "key").distinct(), "texts")
    first = texts.groupBy("id").agg(F.min("key").alias("first"))
    ranked = texts.join(F.broadcast(first), "id").join(F.broadcast(chosen), "id")
    picked = ranked.orderBy(F.col("key") != F.col("first"), F.xxhash64("id", "key"), "id", "key", "label").limit(max_documents)
    picked = written(picked.select("id", "key", "label"), "picked")
    sample = known.join(F.broadcast(picked), ["id", "key"]).dropDuplicates(["id", "key", "label"])

    @F.arrow_udf("binary")
    def bags(texts: pa.Array) -> pa.Array:
        return pa.array([np.concatenate(bag(t.as_py())).astype(np.int32).tobytes() for t in texts], pa.binary())

    rows = written(sample.select("id", "label", bags("text").alias("bag")), "bags")
    found = Bags((r.id, r.label, bytes(r.bag)) for r in rows.toLocalIterator())
    try:
        return train(found)
    finally:
        found.close()


def quality(spark: SparkSession, model: QualityModel, text: Column) -> Column:
    """Column of the probability of label 1 for each whole text; a null text is empty and gets the bias alone."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(texts.to_pylist()))

    return of(text)
