"""The corpus pipeline: stages over ``documents``, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlsift.llm import decontaminate, language_id, line_dedup, mixing, simhash
from urlsift.llm.common import read, small, text_copy, written

#: A document whose best language has a smaller posterior is rejected.
MIN_LANGUAGE_SCORE = 0.5


def _whole(docs: DataFrame) -> DataFrame:
    """The rows as one column, so that no name of theirs meets one of a stage, beside their id and ``text_copy``."""
    rows = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    return docs.select(rows).select("doc", F.col("doc.doc_id").alias("id"), text_copy(F.col("doc.text")).alias("copy"))


def _named(found: DataFrame) -> DataFrame:
    """(of_id, of_copy) of some rows of an operator's result."""
    return small(found.select(F.col("id").alias("of_id"), F.col("copy").alias("of_copy")).distinct())


def _is_named():
    return F.equal_null("id", "of_id") & (F.col("copy") == F.col("of_copy"))


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language identification, learned from the labelled documents: those without a letter, or
    without a language that is likelier than all others together, go."""
    model = language_id.fit_languages(docs, F.col("text"), F.col("lang"))
    found = _whole(docs).withColumn("p", language_id.language(spark, model, F.col("doc.text")))
    sure = (F.col("p.lang_pred") != language_id.UNDETERMINED) & (F.col("p.score") >= MIN_LANGUAGE_SCORE)
    return found.filter(sure).select("doc.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: every document stays, with the lines it keeps. A null text becomes empty."""
    found = line_dedup.dedup_lines(docs)
    own = {"text": F.col("kept"), "n_chars": F.length("kept").cast(docs.schema["n_chars"].dataType)}
    return found.select(*[own.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def keep_representatives(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each component the document with the smallest id stays, once."""
    best = written(simhash.representatives(simhash.near_duplicates(docs)), "representatives")
    rows = _whole(docs)
    once = rows.join(_named(best.filter("repeats = 1")), _is_named(), "left_semi")
    repeated = rows.join(_named(best.filter("repeats > 1")), _is_named(), "left_semi").dropDuplicates(["id", "copy"])
    return once.union(repeated).select("doc.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents of which one word in twenty lies in a benchmark phrase go."""
    found = decontaminate.contamination(docs, read(spark, sf_dir, "benchmark")).filter(decontaminate.is_contaminated())
    return _whole(docs).join(_named(found), _is_named(), "left_anti").select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: how many words of each document the mix takes."""
    found = mixing.mix(docs).taken()
    return found.select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "taken")


STAGES = [
    ("language", keep_identified),
    ("lines", drop_repeated_lines),
    ("near_duplicates", keep_representatives),
    ("decontamination", drop_contaminated),
    ("mix", mix_sources),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
