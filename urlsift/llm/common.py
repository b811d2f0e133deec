"""Helpers the operators share: reading tables, packed text, word blocks; and the library's session helpers."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urlsift.runtime import drop_written, small, tidy, work_dir, written

__all__ = ["ascii_lower", "drop_written", "packed", "read", "small", "span_sums", "text_copy", "tidy", "word_blocks", "work_dir", "written"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PACK = 1 << 18


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def text_copy(text: Column) -> Column:
    """Tells apart rows that share an id but not a text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def packed(
    texts: Iterable[str], reach: int, fold: Callable[[str], str] = str, size: int = PACK
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Whole texts as code points, in packs of about ``size``: (codes, begin, end, owner).

    Piece ``k`` covers the positions ``begin[k]:end[k]`` of text ``owner[k]``; ``reach`` more
    positions follow it, the text's next code points or zeros behind its end. A text longer than
    ``size`` comes in several pieces, so memory doesn't follow the longest text.
    """
    pad = "\0" * reach
    buf: list[str] = []
    begin: list[int] = []
    end: list[int] = []
    owner: list[int] = []
    at = 0

    def pack():
        codes = np.frombuffer("".join(buf).encode("utf-32-le"), np.uint32)
        return codes, np.array(begin, np.int64), np.array(end, np.int64), np.array(owner, np.int64)

    for i, raw in enumerate(texts):
        text = fold(raw)
        for a in range(0, max(len(text), 1), size):
            n = min(size, len(text) - a)
            piece = text[a : a + n + reach]
            buf.append(piece + pad[: n + reach - len(piece)])
            begin.append(at)
            end.append(at + n)
            owner.append(i)
            at += n + reach
            if at >= size:
                yield pack()
                buf, begin, end, owner, at = [], [], [], [], 0
    if buf:
        yield pack()


_BLANK = re.compile(rb"[\x20\x09-\x0d]")


def word_blocks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words between ASCII white space, of about ``size`` bytes at a time."""
    at = 0
    while at < len(data):
        cut = _BLANK.search(data, at + size)
        end = cut.start() if cut else len(data)
        yield data[at:end].split()
        at = end


def span_sums(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sum of ``values[b:e]`` for each pair; zero for an empty span."""
    ends = np.empty(2 * len(begin), np.int64)
    ends[::2], ends[1::2] = begin, end
    sums = np.add.reduceat(np.append(values, 0), ends)[::2]
    sums[begin == end] = 0
    return sums
