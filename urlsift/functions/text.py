"""Small text helpers shared by the feature modules."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# What strip() removes: ASCII and Unicode blanks.
BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
LINE_BREAK = r"\r\n|[\n\x0B\f\r\x1C\x1D\x1E\x85\u2028\u2029]"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def line_lengths(text: Column) -> Column:
    """Length of every piece between line breaks, the piece after the last one included."""
    return F.transform(F.split(text, LINE_BREAK), F.length)


def line_count(lengths: Column) -> Column:
    """Number of lines; a break at the very end opens no new line."""
    return F.size(lengths) - F.when(F.element_at(lengths, -1) == 0, 1).otherwise(0)


def longest_line(lengths: Column) -> Column:
    return F.array_max(lengths)


def whole_word_pattern(terms: Sequence[str]) -> str:
    """Any of the terms between non-word characters; meant for lower-case text."""
    ordered = sorted(terms, key=lambda t: (-len(t), t))
    inner = "|".join(re.escape(t).replace(r"\ ", " ") for t in ordered)
    return rf"(?<![\p{{L}}\p{{N}}_])(?:{inner})(?![\p{{L}}\p{{N}}_])"


def has_any_term(text: Column, terms: Sequence[str]) -> Column:
    return text.rlike(whole_word_pattern(terms))


def contains_any(text: Column, needles: Sequence[str]) -> Column:
    found = F.contains(text, F.lit(needles[0]))
    for n in needles[1:]:
        found = found | F.contains(text, F.lit(n))
    return found
