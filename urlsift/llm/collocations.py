"""Phrase collocations by SON partitioning: shards are mined at lowered support, their candidates counted over everything.

Tasks cut the texts into words and write their hashes, zero between pieces, as arrays: the distinct 32-bit hashes of an array, the
frequent ones first, and the number of each word among them. Tasks form ``SHARDS`` shards. A phrase
with at least ``support`` occurrences has, in some shard, at least its share of them: support times the shard's part of the
language's words, rounded up. Each shard is mined completely at that local support, one length after the other: a phrase
is counted if the two phrases one word shorter in it are frequent in the shard. All shards are mined by one grouping a length, by
shard and phrase, so a shard is no task and may have any size. A phrase that isn't frequent in a shard occurs less often there than
the local support, so the local counts bound its occurrences from both sides: those of the union that can reach the support, and don't
by their local counts alone, are counted over all shards, and the phrases that reach it are counted again by their words, so that a hash
decides nothing.

What is frequent travels to the tasks as a bitmap of ``BITS`` bits at most: bits shared by chance let more phrases
through to be counted, and lose none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urlsift.llm.common import LOWER, UPPER, drop_written, small, tidy, word_blocks, written

SUPPORT, LONGEST, FIRST, SHARE = 30, 4, 2_000, 80
#: Shards beyond about support / 2 would lower the local support to one.
SHARDS = 10
#: Positions of a bitmap: 8 MB.
BITS = 1 << 26
#: Words of an array, and words a task holds before it hands arrays on: the more, the fewer times a word's hash is written.
BLOCK, BUFFER = 1 << 19, 1 << 19
#: Tables of hashes, which repeat.
PACKED = {"compression": "zstd"}
#: Small row groups, so that a task reads few arrays at a time; else the writer would first look at their size after 100 arrays.
ROW_GROUPS = {"parquet.block.size": str(4 << 20), "parquet.block.size.row.check.min": "4", **PACKED}
#: Rows of a batch that a task hands on, and phrases it adds up at a time.
ROWS, WINDOWS = 1 << 15, 1 << 21
#: Counted phrases are dealt to a bucket for each so many words, and to this many buckets at least; a bucket is added up in one piece.
#: A window's phrases fall into rows of one bucket and cell each, so that many buckets would leave few phrases in a row.
BUCKET_WORDS, BUCKETS = 1 << 21, 64
#: Rows a language's first ones are chosen from, in parallel, before they meet.
SALTS = 64

#: Spark deletes a job's shuffle files at its end where this is set.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_STEP = np.uint64(0x9E3779B97F4A7C17)
_LOW = np.uint64((1 << 32) - 1)
_BREAKS = ".,;:!?\n\x0b\x0c\r"
_FOLD = bytes.maketrans((UPPER + _BREAKS + "\t").encode(), (LOWER + "." * len(_BREAKS) + " ").encode())


def _stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``written``, without the shuffle files of the job: nothing reads them once the table stands, and they'd lie beside those of all
    other lengths until the driver collects its garbage. Only for writes: a result that is fetched bit by bit still reads its shuffle."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return written(df, name, **options)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


class _Hashes(dict):
    """Place of each word met in a block; the word's hash goes to ``values``, zero for the break between pieces."""

    def __init__(self) -> None:
        super().__init__()
        self.values: list[int] = [0]
        self[b"."] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self.values)
        self.values.append(xxhash.xxh32_intdigest(word) or 1)
        return at


def _buffers(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, _Hashes]]:
    """(lang, places of words, their table) of about BUFFER words each; whole texts, each closed by a break."""
    held: dict[str, tuple[list[np.ndarray], _Hashes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            parts, table = held.setdefault(lang, ([], _Hashes()))
            data = text.as_buffer().to_pybytes().translate(_FOLD).replace(b".", b" . ")
            for words in word_blocks(data):
                parts.append(np.fromiter(map(table.__getitem__, words), np.int32, len(words)))
                size += len(words)
            parts.append(np.zeros(1, np.int32))
            size += 1
            if size >= BUFFER:
                yield from ((k, np.concatenate(p), t) for k, (p, t) in held.items())
                held, size = {}, 0
        pa.default_memory_pool().release_unused()
    yield from ((k, np.concatenate(p), t) for k, (p, t) in held.items())


def _spread(hashes: np.ndarray) -> np.ndarray:
    """32-bit hashes over 64 bits; zero stays zero, and none else becomes it."""
    return hashes.astype(np.uint64) * _STEP


def _kind(table: np.ndarray) -> type:
    return np.uint16 if len(table) <= 1 << 16 else np.uint32


def _numbered(places: np.ndarray, hashes: np.ndarray) -> tuple[bytes, bytes]:
    """The hashes that occur, the most frequent first, and each place's number among them, in 16 bits if that is enough."""
    n = np.bincount(places, minlength=len(hashes))
    order = np.argsort(-n, kind="stable")[: np.count_nonzero(n)]
    number = np.zeros(len(hashes), _kind(order))
    number[order] = np.arange(len(order))
    return hashes[order].tobytes(), number[places].tobytes()


def _codes(table: pa.Buffer, numbers: pa.Buffer) -> np.ndarray:
    """The spread hash of each place of what was ``_numbered``."""
    hashes = np.frombuffer(table, np.uint32)
    return _spread(hashes)[np.frombuffer(numbers, _kind(hashes))]


def _arrays(shards: int) -> Callable:
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() % shards
        for lang, places, table in _buffers(batches):
            hashes = np.array(table.values, np.uint32)
            for at in range(0, len(places), BLOCK):
                part = places[at : at + BLOCK]
                cells = [[lang], [shard], [len(part)], [int(np.count_nonzero(part))], *([x] for x in _numbered(places[at : at + BLOCK + LONGEST - 1], hashes))]
                types = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, types, strict=True)], ["lang", "shard", "starts", "words", "table", "numbers"])

    return cut


def grams(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of the phrase of ``size`` words that begins at each place, and whether it stays inside one piece."""
    n = max(len(codes) - size + 1, 0)
    found, inside = codes[:n], codes[:n] != 0
    for k in range(1, size):
        found = found * _STEP + codes[k : k + n]
        inside = inside & (codes[k : k + n] != 0)
    return found, inside


def _set(bits: np.ndarray, found: np.ndarray, salt: int) -> np.ndarray:
    """Whether the bit of each hash is set."""
    at = (found ^ np.uint64(salt & (1 << 64) - 1)) & np.uint64(BITS - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _bitmap(keys: DataFrame, salt: str | None) -> np.ndarray:
    """The bitmap of the hashes in ``fp``, mixed with a column; its parts of 4 KB are made by Spark, and together have BITS bits."""
    key = F.col("fp").bitwiseXOR(F.col(salt)) if salt else F.col("fp")
    at = key.bitwiseAND(F.lit(BITS - 1)) + 1
    parts = keys.groupBy(F.bitmap_bucket_number(at).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    bits = np.zeros(BITS // 8, np.uint8)
    for row in parts.toLocalIterator():
        bits[(row.part - 1) * 4096 :][:4096] = np.frombuffer(row.bits, np.uint8)
    return bits


def _planes(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Where the lowest, then the second, third and highest byte of each number lies, in rows of so many numbers that hold all lowest bytes
    first: of small numbers, the higher bytes are zeros in a row, which Spark's shuffle packs."""
    steps = np.repeat(sizes, sizes)
    at = 3 * np.repeat(np.cumsum(sizes) - sizes, sizes) + np.arange(len(steps))
    for _ in range(4):
        yield at
        at = at + steps


def _rows(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The 32-bit numbers as rows of so many, by ``_planes``."""
    data = np.empty(4 * len(values), np.uint8)
    for at, byte in zip(_planes(sizes), values.view(np.uint8).reshape(-1, 4).T, strict=True):
        data[at] = byte
    offsets = np.append(0, 4 * np.cumsum(sizes)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _chunks(found: np.ndarray, cell: int, least: int, buckets: int) -> pa.RecordBatch:
    """The distinct phrases of a window and their counts, a row for each bucket: the lower 32 bits of their hashes, ascending, as the first
    one and the steps to the next ones, and as many counts. The upper bits deal the phrases to the buckets, so that a bucket's number is
    part of what is left of a hash."""
    keys, n = np.unique((found >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32) | found & _LOW, return_counts=True)
    ends = np.searchsorted(keys, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32))
    held = np.flatnonzero(np.diff(ends))
    sizes, low = np.diff(ends)[held], (keys & _LOW).astype(np.uint32)
    steps = np.diff(low, prepend=np.uint32(0))
    steps[ends[held]] = low[ends[held]]
    packs = [_rows(x, sizes) for x in (steps, n.astype(np.uint32))]
    cells = [pa.array(held.astype(np.int32)), *(pa.array(np.full(len(held), x, np.int64)) for x in (cell, least)), *packs]
    return pa.RecordBatch.from_arrays(cells, ["bucket", "cell", "least", "fps", "ns"])


def _unpacked(column: pa.ChunkedArray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ``_rows``, one after the other."""
    data = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in column])
    values = np.zeros(len(data) // 4, np.uint32)
    for k, at in enumerate(_planes(sizes)):
        values |= data[at].astype(np.uint32) << np.uint32(8 * k)
    return values


def _merged(bucket: pa.Table) -> pa.Table:
    """(fp, cell, n): the phrases of a bucket that reach the least count of their cell."""
    cells, of = np.unique(bucket["cell"].to_numpy(), return_inverse=True)
    least = np.zeros(len(cells), np.int64)
    least[of] = bucket["least"].to_numpy()
    sizes = pc.binary_length(bucket["fps"]).to_numpy() // 4
    steps, first = _unpacked(bucket["fps"], sizes), np.cumsum(sizes) - sizes
    low = np.cumsum(steps, dtype=np.uint32)
    low -= np.repeat(low[first] - steps[first], sizes)
    keys = np.repeat(of.astype(np.uint64), sizes) << np.uint64(32) | low
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    n = np.add.reduceat(_unpacked(bucket["ns"], sizes)[order], first, dtype=np.int64)
    keys = keys[first]
    own = (keys >> np.uint64(32)).astype(np.int64)
    kept = n >= least[own]
    fp = (keys[kept] & _LOW).astype(np.int64) | bucket["bucket"][0].as_py() << 32
    return pa.table({"fp": fp, "cell": cells[own[kept]], "n": n[kept]})


def _counted(blocks: DataFrame, cell: str, least: Column, count: Callable, buckets: int) -> DataFrame:
    """(fp, cell, n): phrases of all arrays, as ``count`` names them, added up; those with at least ``least`` occurrences. A task adds up
    WINDOWS phrases at a time, so that a frequent one is an entry for each of these, and sends them packed, a row for each bucket, cell and
    window. Phrases whose hashes agree in bucket and lower bits count as one, so that a count is never too low."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[np.ndarray]] = {}
        size = 0

        def out():
            for (salt, bound), parts in held.items():
                rows = _chunks(np.concatenate(parts), salt, bound, buckets)
                yield from (rows.slice(a, ROWS) for a in range(0, rows.num_rows, ROWS))

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(3)]
            for salt, bound, starts, table, numbers in zip(*columns, batch.column(3), batch.column(4), strict=True):
                for found in count(_codes(table.as_buffer(), numbers.as_buffer()), starts, salt):
                    held.setdefault((salt, bound), []).append(found)
                    size += len(found)
                if size >= WINDOWS:
                    yield from out()
                    held, size = {}, 0
        yield from out()
        pa.default_memory_pool().release_unused()

    rows = blocks.select(F.col(cell).alias("cell"), least.cast("long").alias("least"), "starts", "table", "numbers")
    packs = rows.mapInArrow(run, "bucket int, cell long, least long, fps binary, ns binary")
    return packs.groupBy("bucket").applyInArrow(_merged, "fp long, cell long, n long")


def _mined(blocks: DataFrame, cells: DataFrame, buckets: int) -> list[DataFrame]:
    """(fp, cell, n) of each length: the phrases that reach their shard's local support, and their occurrences there."""
    context, levels, bits = blocks.sparkSession.sparkContext, [], None
    blocks = blocks.join(small(cells.select("cell", "least")), "cell")
    for size in range(1, LONGEST + 1):

        def count(codes: np.ndarray, starts: int, salt: int, size: int = size, bits=bits) -> Iterator[np.ndarray]:
            found, inside = grams(codes, size)
            if bits is not None:
                shorter, _ = grams(codes, size - 1)
                frequent = _set(bits.value, shorter, salt)
                inside = inside & frequent[: len(found)] & frequent[1 : len(found) + 1]
            yield found[:starts][inside[:starts]]

        levels.append(_stored(_counted(blocks, "cell", F.col("least"), count, buckets), "local", **PACKED))
        if bits is not None:
            bits.destroy()
        bits = context.broadcast(_bitmap(levels[-1], "cell")) if size < LONGEST else None
    return levels


def _possible(levels: list[DataFrame], cells: DataFrame, support: int) -> DataFrame:
    """(fp, lang_cell, known): the phrases that are frequent in some shard of a language and may reach the support over all of them, if
    every other shard held as many as one that isn't frequent there can; and their occurrences in the shards where they are frequent."""
    union = levels[0]
    for level in levels[1:]:
        union = union.union(level)
    others = cells.groupBy("lang_cell").agg(F.sum(F.col("least") - 1).alias("others"))
    bounds = union.join(small(cells), "cell").groupBy("fp", "lang_cell").agg(F.sum(F.col("n") - F.col("least") + 1).alias("beyond"), F.sum("n").alias("known"))
    return bounds.join(small(others), "lang_cell").filter(F.col("beyond") + F.col("others") >= support).select("fp", "lang_cell", "known")


def _candidates(blocks: DataFrame, support: int, shards_cells: DataFrame, buckets: int) -> np.ndarray:
    """The bitmap of the phrases that reach the support over all shards. Those whose occurrences in the shards where they are frequent
    reach it are known; the others are counted over all shards."""
    levels = _mined(blocks, shards_cells, buckets)
    possible = _stored(_possible(levels, shards_cells, support), "possible", **PACKED)
    for level in levels:
        drop_written(level)
    bits = blocks.sparkSession.sparkContext.broadcast(_bitmap(possible.filter(F.col("known") < support), "lang_cell"))

    def count(codes: np.ndarray, starts: int, salt: int) -> Iterator[np.ndarray]:
        for size in range(1, LONGEST + 1):
            found, inside = grams(codes, size)
            found, inside = found[:starts], inside[:starts]
            yield found[inside & _set(bits.value, found, salt)]

    counted = _stored(_counted(blocks, "lang_cell", F.lit(support), count, buckets).select("fp"), "frequent", **PACKED)
    bits.destroy()
    return _bitmap(counted.union(possible.filter(F.col("known") >= support).select("fp")), None)


def _phrases(rows: DataFrame, bitmap: np.ndarray, support: int) -> DataFrame:
    """(lang, size, phrase, f) of the phrases that reach the support, counted by their words."""
    bits = rows.sparkSession.sparkContext.broadcast(bitmap)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, places, table in _buffers(batches):
            codes = _spread(np.array(table.values, np.uint32))[places]
            words = pa.array(list(table), pa.binary())
            for size in range(1, LONGEST + 1):
                found, inside = grams(codes, size)
                at = np.flatnonzero(inside & _set(bits.value, found, 0))
                fp, first, group = np.unique(found[at], return_index=True, return_inverse=True)
                # Places with one hash but other words are told apart.
                lead = at[first][group]
                other = np.zeros(len(at), bool)
                for k in range(size):
                    other |= places[lead + k] != places[at + k]
                n = np.bincount(group[~other], minlength=len(fp))
                starts, counts = np.append(at[first], at[other]), np.append(n, np.ones(other.sum(), np.int64))
                for a in range(0, len(starts), ROWS):
                    part = starts[a : a + ROWS]
                    phrases = pc.binary_join_element_wise(*[words.take(pa.array(places[part + k])) for k in range(size)], b" ")
                    cells = [pa.array([lang] * len(part), pa.string()), pa.array(np.full(len(part), size, np.int32)),
                             phrases.cast(pa.string()), pa.array(counts[a : a + ROWS].astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(cells, ["lang", "size", "phrase", "f"])

    found = rows.mapInArrow(count, "lang string, size int, phrase string, f long")
    return found.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= support)


def _part(first, size):
    return F.array_join(F.slice("w", first, size), " ")


def _scored(phrases: DataFrame) -> DataFrame:
    """(lang, size, phrase, w, a, l, r, score) of the phrases of two words and more, by the cut of the lowest score."""
    longer = phrases.filter("size > 1").withColumnRenamed("f", "a").withColumn("w", F.split("phrase", " "))
    cuts = longer.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumns({"left": _part(F.lit(1), F.col("k")), "right": _part(F.col("k") + 1, F.col("size") - F.col("k"))})
    counts = small(phrases)
    left = counts.select(F.col("lang"), F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = counts.select(F.col("lang"), F.col("phrase").alias("right"), F.col("f").alias("r"))
    cuts = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    score = F.expr("(cast(2000000 as decimal(38, 0)) * cast(a as decimal(19, 0))) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    cuts = cuts.withColumn("score", score.cast("long"))
    best = F.min(F.struct("score", "k", "l", "r")).alias("b")
    return cuts.groupBy("lang", "size", "phrase", "w", "a").agg(best).select("lang", "size", "phrase", "w", "a", "b.l", "b.r", "b.score")


def _outside(scored: DataFrame, share: int) -> DataFrame:
    """Without phrases that lie in a longer one which has at least ``share`` percent of their occurrences."""
    sizes = F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("n")
    parts = scored.filter("size > 2").select("lang", F.col("a").alias("longer"), "w", "size", sizes)
    parts = parts.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("n") + 1)))
    inside = parts.select("lang", "longer", _part(F.col("i"), F.col("n")).alias("phrase")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    wide = "cast({} as decimal(19, 0)) * {}"
    covered = F.expr(f"{wide.format('longer', 100)} >= {wide.format('a', share)}")
    return scored.join(small(inside), ["lang", "phrase"], "left").filter(F.coalesce(~covered, F.lit(True)))


@tidy
def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT, share: int = SHARE, first: int = FIRST, shards: int = SHARDS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``first`` phrases of two to four words of each language by score, then
    occurrences, both descending, then phrase.

    A null language is ``und``, a null text empty. Only A-Z are lower-cased; words end at blanks and tabs, phrases at the marks
    ``.,;:!?`` and line ends. Repeated rows count each time. Empty tables, and languages without a phrase that reaches the support, give
    no row. Other columns aren't read.
    """
    rows = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary").alias("t"),
    )
    blocks = _stored(rows.mapInArrow(_arrays(shards), "lang string, shard int, starts int, words long, table binary, numbers binary"), "arrays", **ROW_GROUPS)
    blocks = blocks.withColumns({"cell": F.xxhash64("lang", "shard"), "lang_cell": F.xxhash64("lang")})
    sizes = _stored(blocks.groupBy("lang", "cell").agg(F.sum("words").alias("words")), "shards")
    totals = _stored(sizes.groupBy("lang").agg(F.sum("words").alias("n")), "totals")
    share_of = F.expr("(cast(words as decimal(19, 0)) * {s} + n - 1) div n".format(s=support))
    cells = sizes.filter("words > 0").join(small(totals), "lang").select("cell", F.xxhash64("lang").alias("lang_cell"), share_of.cast("long").alias("least"))
    cells = _stored(cells, "local-support")
    words = totals.agg(F.sum("n")).first()[0] or 0
    bitmap = _candidates(blocks, support, cells, max(BUCKETS, -(-words // BUCKET_WORDS)))
    drop_written(blocks)
    phrases = _stored(_phrases(rows, bitmap, support), "phrases")
    kept = _stored(_outside(_stored(_scored(phrases), "scored"), share), "kept")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    kept = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    near = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= first)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= first)
    return ranked.join(small(totals), "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
