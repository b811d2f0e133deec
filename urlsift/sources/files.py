"""Readers and writers: labelled CSV, Parquet, compressed pages, URL lists, page store."""

from __future__ import annotations

import gzip
import io
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urlsift import contract as C
from urlsift.functions.text import LINE_BREAK, strip

#: The text a task holds before it hands it on.
BATCH_BYTES = 8 << 20


#: Quotes are doubled inside quotes, and quoted values may hold commas and line breaks. Blanks at the ends belong to a value; an empty
#: field is NULL, an empty value is a pair of quotes.
STANDARD_QUOTES = {
    "header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    "nullValue": "", "emptyValue": '""',
}
#: What the reader makes of a pair of quotes until the columns are typed; noncharacters, which no text holds.
EMPTY = "\uffffempty\ufffe"


def _csv(spark: SparkSession):
    return spark.read.options(**(STANDARD_QUOTES | {"emptyValue": ""}), multiLine=True, mode="FAILFAST")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Standard CSV with a header by a given schema; a broken row or value is an error. An empty field is NULL, a pair of quotes an empty
    text, or NULL in a column that holds no text. A file with line breaks inside quotes can't be split, so large inputs should be many files."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    rows = _csv(spark).option("emptyValue", EMPTY).schema(texts).csv(path)

    def typed(field: T.StructField):
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            return F.when(value == EMPTY, F.lit("")).otherwise(value).alias(field.name)
        value = F.when(value != EMPTY, value)
        cast = value.try_cast(field.dataType)
        broken = F.raise_error(F.concat(F.lit(f"column {field.name} holds no {field.dataType.simpleString()}: "), value)).cast(field.dataType)
        return F.when(value.isNotNull() & cast.isNull(), broken).otherwise(cast).alias(field.name)

    return rows.select(*[typed(f) for f in schema.fields])


def read_records(spark: SparkSession, path: str, labelled: bool = True) -> DataFrame:
    """Raw records from CSV with a header. Columns may come in any order; names beyond the
    contract are ignored, a missing one is an error, and labels are validated."""
    header = _csv(spark).csv(path)
    required = C.RAW if labelled else tuple(c for c in C.RAW if c != C.TARGET)
    C.require_columns(header, required)
    types = {f.name: f.dataType for f in C.RAW_SCHEMA.fields}
    schema = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header.columns])
    df = _csv(spark).option("enforceSchema", True).schema(schema).csv(path).select(*required)
    numbers = [c for c in df.columns if types[c] == T.DoubleType()]
    df = df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in numbers})
    return C.check_labels(df) if labelled else df


def write_csv(df: DataFrame, path: str) -> None:
    """Flat columns as standard CSV with a header."""
    df.write.options(**STANDARD_QUOTES).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _unpacked(raw: bytes, most: int | None) -> str | None:
    """The text of gzip bytes; NULL if they are broken, an error if they hold more than ``most`` bytes."""
    try:
        with gzip.GzipFile(fileobj=io.BytesIO(raw)) as file:
            data = file.read() if most is None else file.read(most + 1)
    except (OSError, EOFError, zlib.error):
        return None
    if most is not None and len(data) > most:
        raise ValueError(f"a page unpacks to more than {most} bytes")
    return data.decode("utf-8", errors="replace")


def _unpack(batches: Iterator[pa.RecordBatch], most: int | None) -> Iterator[pa.RecordBatch]:
    def out():
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string())], names=["sha1", "html"])

    names, texts, size = [], [], 0
    for batch in batches:
        for name, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            names.append(name)
            texts.append(_unpacked(raw.as_py(), most))
            size += len(texts[-1] or "")
            if size >= BATCH_BYTES:
                yield out()
                names, texts, size = [], [], 0
    if names:
        yield out()


def read_pages(spark: SparkSession, path: str, most: int | None = None) -> DataFrame:
    """Pages stored as ``<sha1>.html.gz``: columns sha1 and html.

    Files are split over tasks by Spark; a file that is no gzip gives a NULL page, one that unpacks to more than ``most`` bytes is an error.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.html.gz").load(path)
    named = files.select(F.regexp_extract("path", r"([0-9a-fA-F]+)\.html\.gz$", 1).alias("sha1"), "content")
    return unpacked_store(named, most)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = [gzip.compress(t.encode("utf-8"), mtime=0) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["sha1", "packed"])


def page_store(pages: DataFrame, html: str = "html") -> DataFrame:
    """Distinct pages by content: key is the SHA-1 of the UTF-8 text.

    The page text takes no part in the shuffle key; equal pages meet by their hash.
    """
    hashed = pages.filter(F.col(html).isNotNull()).withColumn("sha1", F.sha1(F.encode(html, "UTF-8")))
    return hashed.dropDuplicates(["sha1"])


def packed_store(pages: DataFrame, html: str = "html") -> DataFrame:
    """The page store with each page as gzip bytes, ready to be written as a table."""
    return page_store(pages, html).select("sha1", html).mapInArrow(_pack, "sha1 string, packed binary")


def unpacked_store(packed: DataFrame, most: int | None = None) -> DataFrame:
    """A packed store as sha1 and html."""
    return packed.mapInArrow(lambda batches: _unpack(batches, most), "sha1 string, html string")


def corpus_gaps(expected: DataFrame, stored: DataFrame) -> DataFrame:
    """Expected hashes without a page, and pages nobody expects."""
    lost = expected.select("sha1").distinct().join(stored.select("sha1"), "sha1", "left_anti")
    extra = stored.select("sha1").distinct().join(expected.select("sha1"), "sha1", "left_anti")
    return lost.withColumn("problem", F.lit("page missing")).unionByName(
        extra.withColumn("problem", F.lit("not expected"))
    )


def url_lines(texts: DataFrame, text: str, keys: Sequence[str] = (), cap: int | None = None) -> DataFrame:
    """URLs of submitted lists: one per line, trimmed, blanks dropped; all, or the first ``cap``
    of each list. Each list stays on its row until it is cut."""
    lines = F.filter(F.transform(F.split(text, LINE_BREAK), strip), lambda u: u != "")
    kept = F.slice(lines, 1, cap) if cap else lines
    return texts.select(*keys, F.posexplode(kept).alias("line", "url"))


def read_suffix_rules(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Public-suffix rules from text, one per line: blanks and lines that begin with "//" are passed over, names in other
    scripts are taken in the form resolvers see. The list is some ten thousand names long."""
    lines = spark.read.text(path).select(F.lower(F.regexp_extract(strip(F.col("value")), r"^\S+", 0)).alias("rule"))
    kept = lines.filter((F.col("rule") != "") & ~F.startswith("rule", F.lit("//"))).distinct().orderBy("rule")

    def plain(rule: str) -> str:
        mark = "*." if rule.startswith("*.") else "!" if rule.startswith("!") else ""
        return mark + rule[len(mark) :].encode("idna").decode("ascii")

    return tuple(plain(r.rule) for r in kept.collect())


def read_url_list(spark: SparkSession, path: str, cap: int | None = None) -> DataFrame:
    """The same for text files, one list per file."""
    return url_lines(spark.read.option("wholetext", True).text(path), "value", cap=cap)
