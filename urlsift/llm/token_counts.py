"""Token counts by a map-side two-tier lookup of pre-token lengths.

A byte-level vocabulary cuts a text into pre-tokens and encodes each on its own, so a text's number of tokens is the sum of its
pre-tokens' lengths. The first tier is a broadcast table with the lengths of the most frequent pre-tokens of the corpus; what it lacks
is encoded once and kept in a bounded cache of the worker, the second tier. No pre-token is ever shuffled: tasks hand
on their most frequent pieces in one summary row each, and only summaries are merged.

Which pre-tokens the table and the cache hold decides the speed alone; every count is that of the library. Characters that
the library and the pattern put into different classes (they follow different Unicode versions) are found by
asking the library, once a character and worker; texts that hold one are encoded whole.
"""

from __future__ import annotations

import json
import os
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries of the broadcast table, and of a task's or a merger's summary.
TABLE, SUMMARY = 1 << 15, 1 << 13
#: Distinct pieces a task counts before it forgets the rarer half of them.
HELD = 1 << 17
#: Entries of a worker's cache; longer pre-tokens than KEPT characters aren't kept in either tier.
CACHE, KEPT = 1 << 18, 64
#: Summaries that come to the driver; texts are cut where a pre-token begins, after about this many characters.
SUMMARIES, PART = 64, 1 << 20

_CUT = regex.compile(r"\S(?=\x20)")


class _Lengths(dict):
    """The worker's cache, which encodes what it lacks."""

    def __init__(self, encode) -> None:
        self.encode = encode

    def __missing__(self, piece: str) -> int:
        n = len(self.encode(piece).ids)
        if len(piece) <= KEPT:
            if len(self) >= CACHE:
                self.clear()
            self[piece] = n
        return n


class TokenCounter:
    """Counts tokens as the vocabulary file does, without added tokens at the ends, truncation or padding."""

    def __init__(self, definition: str) -> None:
        parts = json.loads(definition)
        before = parts["pre_tokenizer"] or {}
        whole = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        plain = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in parts["added_tokens"])
        if not whole or not plain or parts["normalizer"] or parts["model"]["type"] != "BPE":
            raise ValueError("expected a byte-level BPE vocabulary that cuts by the usual pattern and has plain added tokens")
        self.definition = json.dumps({**parts, "truncation": None, "padding": None, "post_processor": None})
        self.added = [t["content"] for t in parts["added_tokens"]]
        self.table: dict[str, int] = {}

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("definition", "added", "table")}

    def _ready(self) -> None:
        if "lookup" not in self.__dict__:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_str(self.definition)
            self.cut = regex.compile(PATTERN)
            longest = sorted(self.added, key=len, reverse=True)
            self.special = regex.compile("|".join(map(regex.escape, longest))) if longest else None
            self.agreed: set[str] = set()
            self.odd: set[str] = set()
            self.cache = _Lengths(lambda piece: self.tokenizer.encode(piece, add_special_tokens=False))
            table, cache = self.table.get, self.cache
            self.lookup = lambda piece: table(piece) or cache[piece]

    def _agrees(self, text: str) -> bool:
        """Whether the pattern cuts at the characters of the text as the library does."""
        new = set(text) - self.agreed
        for c in new - self.odd:
            probe = f"a{c}1{c}!{c} \n"
            ends = [end for _, (_, end) in self.tokenizer.pre_tokenizer.pre_tokenize_str(probe)]
            (self.agreed if ends == [m.end() for m in self.cut.finditer(probe)] else self.odd).add(c)
        return not new & self.odd

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens, a part of the text at a time; a part ends before a space that follows another character."""
        at = 0
        while at < len(text):
            found = _CUT.search(text, at + PART)
            end = found.end() if found else len(text)
            yield self.cut.findall(text[at:end])
            at = end

    def count(self, text: str) -> int:
        self._ready()
        if not self._agrees(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        n = 0
        if self.special and any(x in text for x in self.added):
            n = sum(1 for _ in self.special.finditer(text))
            spans = self.special.split(text)
        else:
            spans = [text]
        return n + sum(sum(map(self.lookup, part)) for span in spans for part in self.pieces(span))

    def lengths(self, pieces: Iterable[str]) -> dict[str, int]:
        """Lengths of the pre-tokens of some words; those that hold a character of doubtful class are left to the cache."""
        self._ready()
        cut = {p for word in pieces if self._agrees(word) for p in self.cut.findall(word) if len(p) <= KEPT}
        return {p: len(self.tokenizer.encode(p, add_special_tokens=False).ids) for p in sorted(cut)}


def _thinned(counts: Counter, limit: int) -> Counter:
    return Counter(dict(counts.most_common(limit))) if len(counts) > limit else counts


def _summary(counts: Counter) -> Iterator[pa.RecordBatch]:
    top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:SUMMARY]
    if top:
        pieces, n = zip(*top, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array([list(pieces)]), pa.array([list(n)], pa.list_(pa.int64()))], ["pieces", "n"])


def _frequent(docs: DataFrame, text: Column) -> Counter:
    """Counts of frequent words, each with the space before it, from all texts: in a task only the most frequent are kept."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            for t in batch.column(0):
                t = t.as_py()
                for at in range(0, len(t), PART):
                    counts.update(t[at : at + PART].split())
                    if len(counts) > HELD:
                        counts = _thinned(counts, HELD // 2)
        yield from _summary(counts)

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            for pieces, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for p, k in zip(pieces, n, strict=True):
                    counts[p] += k
                counts = _thinned(counts, HELD)
        yield from _summary(counts)

    schema = "pieces array<string>, n array<long>"
    rows = docs.select(text.cast("string").alias("t")).filter("t is not null")
    parts = rows.mapInArrow(count, schema).repartition(SUMMARIES).mapInArrow(merge, schema)
    total = Counter()
    for row in parts.toLocalIterator():  # at most SUMMARIES rows of SUMMARY entries
        for p, k in zip(row.pieces, row.n, strict=True):
            total[p] += k
    return total


def fit_counter(docs: DataFrame, text: Column, path: str, table: int = TABLE) -> TokenCounter:
    """A counter for the vocabulary file at ``path`` (read on the driver alone and sent along), with the lengths of the ``table``
    most frequent pre-tokens of the texts. Null texts have none; no text gives an empty table."""
    with open(path, encoding="utf-8") as f:
        counter = TokenCounter(f.read())
    top = sorted(_frequent(docs, text).items(), key=lambda x: (-x[1], x[0]))[:table]
    counter.table = dict(list(counter.lengths(f" {word[:PART]}" for word, _ in top).items())[: 2 * table])
    for name in ("lookup", "tokenizer", "cut", "special", "agreed", "odd", "cache"):
        counter.__dict__.pop(name, None)
    return counter


def tokens(spark: SparkSession, counter: TokenCounter, text: Column) -> Column:
    """Column with the number of tokens of each whole text; a null or empty text has none."""
    shared = spark.sparkContext.broadcast(counter)

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        count = shared.value.count
        return pa.array([count(t) if (t := x.as_py()) else 0 for x in texts], pa.int64())

    return of(text)
