"""Benchmark decontamination over a distributed positional inverted index.

The index stores a posting (term, document, position) for every training token that is a term of the
test items, and a row without a term behind each document's last word, so that one pass over the texts gives postings and numbers of words. A window of an item starts from the postings of its rarest term, each shifted by the term's
offset to the place where the item would begin, and is intersected with the shifted lists of the next rarer
terms. Alignments that survive are intersected with the lists of all the item's terms; runs of
consecutive matches are the exact phrases. Proximity matches allow each term some positions of play and some
terms to be absent: with ``m`` absences allowed, one of a window's m + 1 rarest terms is present, and of m + 1 + j at least
j + 1, so places where too few of them stand together are left out before all terms are looked up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urlsift.llm.common import ascii_lower, small, text_copy, tidy, written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
#: Intersections by single terms, from the second rarest on, before whole items are compared.
NARROWING = 2

DOC = ["id", "copy"]
#: Sets the copies of rows without an id apart from those of the id they are filled with.
NO_ID = 0x5851F42D4C957F2D
#: Stands behind the last word of a document; no word is empty.
END = ""
PLACE = ["term", *DOC, "pos"]


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _documents(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """id, copy, t, no_id: ``copy`` tells rows apart that share an id but not a text, and rows without an id from
    those of the id zero, so that id and copy are never null."""
    t, given = F.col(f"`{text}`").cast("string"), F.col(f"`{doc_id}`")
    copy = F.when(given.isNull(), text_copy(t).bitwiseXOR(F.lit(NO_ID))).otherwise(text_copy(t))
    filled = F.coalesce(given, F.lit(0).cast(docs.schema[doc_id].dataType))
    return docs.select(filled.alias("id"), copy.alias("copy"), t.alias("t"), given.isNull().alias("no_id"))


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, item_id, n, i, word, term): each word of each item; rows that repeat an item count once."""
    rows = items.select(F.col(f"`{item_id}`").alias("item_id"), words(F.col(f"`{text}`").cast("string")).alias("w"))
    rows = rows.withColumn("item", F.xxhash64("item_id", "w")).dropDuplicates(["item"])
    rows = rows.select("item", "item_id", F.size("w").alias("n"), F.posexplode("w").alias("i", "word"))
    return rows.withColumn("term", F.xxhash64("word"))


def build_index(documents: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Write the postings (term, id, copy, pos) of all tokens of whole texts that are in ``vocabulary`` (word, term), sorted by
    term within each part, and for each document row one without a term whose ``pos`` is its number of words. The words
    themselves decide; the hash only names a word of the vocabulary."""
    tokens = F.posexplode(F.concat(words(F.col("t")), F.array(F.lit(END)))).alias("pos", "word")
    end = documents.sparkSession.range(1).select(F.lit(END).alias("word"), F.lit(None).cast("long").alias("term"))
    postings = documents.select(*DOC, "no_id", tokens).join(small(vocabulary.union(end)), "word").select(*PLACE, "no_id")
    return written(postings.sortWithinPartitions("term", "id", "pos"), "postings")


def postings_of(index: DataFrame) -> DataFrame:
    return index.filter("term is not null").select(*PLACE)


def _ranked_windows(terms: DataFrame, counts: DataFrame, window: int) -> DataFrame:
    """(item, first, list): the terms of each window as (postings, i, term), rarest first; terms that no document holds have
    zero postings."""
    known = terms.join(small(counts), "term", "left").withColumn("postings", F.coalesce("postings", F.lit(0)))
    last = F.greatest(F.col("n") - window, F.lit(0))
    firsts = F.sequence(F.greatest(F.col("i") - (window - 1), F.lit(0)), F.least("i", last))
    placed = known.withColumn("first", F.explode(firsts))
    return placed.groupBy("item", "first").agg(F.sort_array(F.collect_list(F.struct("postings", "i", "term"))).alias("list"))


def _alignments(index: DataFrame, ranked: DataFrame) -> DataFrame:
    """(item, first, list, id, copy, start): one row per occurrence of each window's rarest term."""
    seeds = ranked.withColumn("term", F.col("list")[0]["term"])
    found = index.join(small(seeds), "term")
    return found.withColumn("start", F.col("pos") - F.col("list")[0]["i"]).drop("term", "pos")


def _narrowed(index: DataFrame, found: DataFrame, rank: int) -> DataFrame:
    """Keep alignments whose window has its ``rank``-th rarest term at its place, or has no such term."""
    found = written(found, "alignments")
    term = F.get(F.col("list"), F.lit(rank))
    asked = found.withColumn("term", term["term"]).withColumn("pos", F.col("start") + term["i"])
    lists = index.join(small(asked.select("term").filter("term is not null").distinct()), "term", "left_semi")
    hit = asked.filter("term is not null").join(lists, PLACE, "left_semi")
    return hit.select(found.columns).union(asked.filter("term is null").select(found.columns))


def phrase_matches(index: DataFrame, terms: DataFrame, window: int = WINDOW) -> DataFrame:
    """(id, copy, item, item_id, start, length): maximal runs of item words found word by word from position
    ``start`` on, at least ``window`` long, or the whole of a shorter item."""
    counts = index.groupBy("term").agg(F.count("*").alias("postings"))
    whole = _ranked_windows(terms, counts, window).filter(F.col("list")[0]["postings"] > 0)
    found = _alignments(index, written(whole, "windows"))
    for rank in range(1, 1 + NARROWING):
        found = _narrowed(index, found, rank)
    survivors = written(found.select(*DOC, "item", "start").distinct(), "survivors")
    expected = survivors.join(small(terms), "item").withColumn("pos", F.col("start") + F.col("i"))
    lists = index.join(small(survivors.select(*DOC).distinct()), DOC, "left_semi")
    matched = expected.join(lists, PLACE, "left_semi")
    run = Window.partitionBy(*DOC, "item", "start").orderBy("i")
    matched = matched.withColumn("run", F.col("i") - F.row_number().over(run))
    runs = matched.groupBy(*DOC, "item", "item_id", "n", "start", "run").agg(F.min("i").alias("i"), F.count("*").alias("length"))
    long_enough = F.col("length") >= F.least("n", F.lit(window))
    return runs.filter(long_enough).select(*DOC, "item", "item_id", (F.col("start") + F.col("i")).alias("start"), "length")


def _together(found: DataFrame, play: int, least: Column) -> DataFrame:
    """The rows (id, copy, item, at, ...) with at least ``least`` rows, themselves included, whose ``at`` one start can reach."""
    around = Window.partitionBy(*DOC, "item").orderBy("at").rangeBetween(-2 * play, 2 * play)
    return found.withColumn("around", F.count("*").over(around)).filter(F.col("around") >= least).drop("around")


def proximity_matches(index: DataFrame, terms: DataFrame, window: int = WINDOW, play: int = 2, share: float = 0.8) -> DataFrame:
    """(id, copy, item, item_id, first, start, near): places where at least ``share`` of the words of an item's window (the
    whole of a shorter item), which begins at the item's word ``first``, stand within ``play`` positions of where they
    are when the item begins at ``start``; ``near`` counts those words. All such places are found."""
    counts = index.groupBy("term").agg(F.count("*").alias("postings"))
    size = F.least("n", F.lit(window))
    need = F.greatest(F.ceil(size * share), F.lit(1))
    ranked = _ranked_windows(terms, counts, window).join(small(terms.select("item", "n").distinct()), "item")
    asked = F.least(size, size - need + 1 + NARROWING).cast("int")
    seeds = ranked.select("item", (asked - (size - need)).alias("least"), F.explode(F.slice("list", F.lit(1), asked)).alias("seed"))
    seeds = written(seeds.select("item", "least", "seed.i", "seed.term").distinct(), "seeds")
    found = index.join(small(seeds), "term").select(*DOC, "item", "least", (F.col("pos") - F.col("i")).alias("at"))
    pairs = written(_together(found, play, F.col("least")).select(*DOC, "item").distinct(), "near-pairs")
    lists = index.join(small(pairs.select(*DOC).distinct()), DOC, "left_semi")
    hits = pairs.join(small(terms), "item").join(lists, ["term", *DOC]).withColumn("at", F.col("pos") - F.col("i"))
    hits = _together(hits, play, need)
    key = [*DOC, "item", "item_id", "n", "start"]
    reached = hits.withColumn("start", F.explode(F.sequence(F.col("at") - play, F.col("at") + play))).select(*key, "i").distinct()
    firsts = F.sequence(F.greatest(F.col("i") - size + 1, F.lit(0)), F.least("i", F.col("n") - size))
    near = reached.withColumn("first", F.explode(firsts)).groupBy(*key, "first").agg(F.count("*").alias("near"))
    return near.filter(F.col("near") >= need).drop("n").select(*DOC, "item", "item_id", "first", "start", "near")


@tidy
def contamination(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, near: bool = False,
) -> DataFrame:
    """(id, copy, n_words, n_hit, n_items, item_ids) for each document row; with ``near`` also (n_near, near_ids): the items
    that have a proximity match, those with a phrase among them.

    Words inside any phrase match are hit. Null and empty texts have no words; items without words are
    ignored; an item without an id hits words but isn't listed. Rows that repeat an id each get the counts of
    their own text. Empty tables give empty results or zeros. Other columns aren't read.
    """
    documents = _documents(docs, doc_id, text)
    terms = written(item_terms(items, item_id, item_text), "item-terms")
    whole = build_index(documents, terms.select("word", "term").distinct())
    index = postings_of(whole)
    phrases = written(phrase_matches(index, terms, window), "phrases")
    named = F.sort_array(F.collect_set(F.col("item_id").cast("string")))
    if near:
        close = written(proximity_matches(index, terms, window).groupBy(*DOC).agg(named.alias("near_ids")), "near")
    inside = F.explode(F.sequence(F.col("start"), (F.col("start") + F.col("length") - 1).cast("int")))
    hit = phrases.select(*DOC, inside.alias("pos")).distinct().groupBy(*DOC).agg(F.count("*").alias("n_hit"))
    listed = phrases.groupBy(*DOC).agg(named.alias("item_ids"))
    marks = hit.join(listed, DOC)
    counted = whole.filter("term is null").select(*DOC, "no_id", F.col("pos").cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    copy = F.when(F.col("no_id"), F.col("copy").bitwiseXOR(F.lit(NO_ID))).otherwise(F.col("copy"))
    marked = counted.join(marks, DOC, "left")
    lists = {"n_items": "item_ids"}
    if near:
        marked, lists = marked.join(close, DOC, "left"), lists | {"n_near": "near_ids"}
    sizes = [(F.coalesce(F.size(x), F.lit(0)).cast("long").alias(n), F.coalesce(x, none).alias(x)) for n, x in lists.items()]
    return marked.select(
        F.when(~F.col("no_id"), F.col("id")).alias("id"), copy.alias("copy"), "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        *[c for pair in sizes for c in pair],
    )


def is_contaminated() -> Column:
    """At least one word in twenty is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
