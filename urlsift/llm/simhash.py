"""SimHash near-duplicates by multi-index hashing.

A fingerprint is the bitwise majority of the XXH64 values of a text's word shingles. Distinct fingerprints
are cut into segments; a pair within ``distance`` bits agrees up to a few bits in one of them, so each
fingerprint looks up the small Hamming ball around each of its segments in the segment tables, and the
complete distance of what is found is verified. Links join components of fingerprints, never of documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlsift.llm.common import drop_written, text_copy, word_blocks, written
from urlsift.llm.components import components

SHINGLE = 3
DISTANCE = 3
SEGMENTS = 2
SEED = 42


def text_fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is set in over half of the shingles' hashes; a text of fewer words than a
    shingle is one shingle, a text without words (or null) has fingerprint zero."""
    counts, total, carry, hash64 = np.zeros(64, np.int64), 0, [], xxhash.xxh64_intdigest

    def add(shingles):
        values = np.fromiter((hash64(s, SEED) for s in shingles), np.uint64)
        counts[:] += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        return len(values)

    for words in word_blocks((text or "").encode().lower()):
        words = carry + words
        if len(words) >= shingle:
            total += add(map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False)))
        carry = words[max(0, len(words) - shingle + 1) :] if shingle > 1 else []
    if not total and carry:
        total = add([b" ".join(carry)])
    return sum(1 << i for i in np.flatnonzero(2 * counts > total).tolist()) if total else 0


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed 64-bit integer."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        values = np.array([text_fingerprint(t.as_py(), shingle) for t in texts], np.uint64)
        return pa.array(values.view(np.int64))

    return of(text)


def _segments(distance: int, segments: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of each segment that has to be searched. With distance = q * segments + r,
    the first r + 1 segments need radius q and the others q - 1: were all beyond, the sum would exceed it."""
    q, r = divmod(distance, segments)
    out, shift = [], 0
    for k in range(segments):
        width = 64 // segments + (k < 64 % segments)
        radius = q if k <= r else q - 1
        if radius >= 0:
            out.append((shift, width, radius))
        shift += width
    return out


def _ball(width: int, radius: int) -> list[int]:
    masks = {0}
    for _ in range(radius):
        masks |= {m ^ (1 << b) for m in masks for b in range(width)}
    return sorted(masks)


def links(prints: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """Pairs (a, b), a < b, of the distinct values ``fp`` at no more than ``distance`` bits."""
    tables, probes = [], []
    for k, (shift, width, radius) in enumerate(_segments(distance, segments)):
        part = F.shiftrightunsigned("fp", shift)
        part = part.bitwiseAND(F.lit((1 << width) - 1)) if width < 64 else part
        masks = F.array(*[F.lit(m - (m >> 63 << 64)).cast("long") for m in _ball(width, radius)])
        tables.append(prints.select(F.lit(k).alias("segment"), part.alias("key"), F.col("fp").alias("b")))
        around = prints.select(F.col("fp").alias("a"), part.alias("part"), F.explode(masks).alias("mask"))
        probes.append(around.select(F.lit(k).alias("segment"), F.col("part").bitwiseXOR(F.col("mask")).alias("key"), "a"))
    table, probe = tables[0], probes[0]
    for t, p in zip(tables[1:], probes[1:], strict=True):
        table, probe = table.union(t), probe.union(p)
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    # Spark sizes the probes as if they weren't exploded, and would broadcast them: both sides are shuffled
    return probe.join(table.hint("merge"), ["segment", "key"]).filter(near).select("a", "b").distinct()


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE, segments: int = SEGMENTS
) -> DataFrame:
    """(id, copy, fp, root, component) for each row: ``component`` is the smallest id reachable by links of at most
    ``distance`` bits, ``root`` the component's smallest fingerprint; ``copy`` is ``text_copy`` of the text, which tells
    rows apart that share an id.

    Equal fingerprints are linked, the zero of wordless and null texts too. Repeated rows stay repeated.
    Null ids belong to their component but never name one that has another id. Other columns aren't read.
    """
    t = F.col(f"`{text}`").cast("string")
    prints = docs.select(F.col(f"`{doc_id}`").alias("id"), text_copy(t).alias("copy"), fingerprint(t, shingle).alias("fp"))
    prints = written(prints, "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min("id").alias("low")), "distinct-fingerprints")
    edges = written(links(distinct.select("fp"), distance, segments), "fingerprint-links")
    roots = components(edges)
    drop_written(edges)
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("low").alias("component"))
    named = rooted.join(smallest, "root").select("fp", "root", "component")
    return prints.join(named, "fp").select("id", "copy", "fp", "root", "component")


def representatives(found: DataFrame) -> DataFrame:
    """Of the rows of ``near_duplicates`` one (id, copy, repeats) for each component, the smallest; a row without an id only
    where no row has one. ``repeats`` counts the equal rows behind it."""
    rows = found.groupBy("root", "id", "copy").agg(F.count("*").alias("repeats"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "copy", "repeats")).alias("first")
    return rows.groupBy("root").agg(first).select("first.id", "first.copy", "first.repeats")
