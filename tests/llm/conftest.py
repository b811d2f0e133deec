import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from urlsift.llm.common import read  # noqa: E402

LONG = " ".join(f"w{k % 977}x{k % 13}" for k in range(60_000))
LINE = "This line stands in many of the documents."

#: doc_id, text, lang, source, n_chars: nulls in every column, empty, blank and very long texts, ties, repeated rows.
MESSY = [
    (1, f"first of all\n{LINE}\nshort\n{LINE}", "en", "a", 1),
    (2, f"  {LINE.upper()}\t\nown words of the second one\nshort", "en", "a", 2),
    (2, f"  {LINE.upper()}\t\nown words of the second one\nshort", "en", "a", 2),
    (3, "", "en", "b", 0),
    (4, None, None, None, None),
    (5, " \n\t\n", None, "b", 3),
    (6, LONG, "fr", "c", 9),
    (7, LONG + " tail", "fr", "c", 9),
    (None, f"{LINE}\nwithout an id", None, "a", None),
    (None, "own words of the second one", "de", None, None),
    (8, "Ünïcode straße ÀÉ 漢字 кириллица\n" + "ÀÉ" * 6, "de", None, 5),
    (9, "ÀÉ" * 6 + "\n" + "àé" * 6 + "\r\n" + LINE, "de", "c", 5),
    (10, "the quick brown fox jumps over the lazy dog and runs far away from it", "en", "a", 1),
    (11, "the quick brown fox jumps over the lazy dog and runs far away from it", "en", "d", 1),
    (12, "12345 67890 !!", None, "d", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def messy(spark):
    """The messy documents with extra columns whose names the operators use inside."""
    import pyspark.sql.functions as F

    extra = ["id", "copy", "t", "key", "pos", "term", "s", "size", "fp", "batch", "h1", "doc", "label", "l", "_p", "_id", "_copy", "p", "of_id", "of_copy"]
    return spark.createDataFrame(MESSY, SCHEMA).withColumns({c: F.lit(c) for c in extra}).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return read(spark, sf, "documents")


@pytest.fixture
def folder(spark, tmp_path):
    """Writes tables for a registered query."""

    def put(**tables):
        for name, df in tables.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return put
