"""The column contract: names, order, groups and the checks made on a schema.

Everything here is plain data about column names. No Spark job is started by
this module except in :func:`check_labels`, which needs one aggregate.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

@dataclass(frozen=True)
class Field:
    """A column of the record file: what kind of value it holds, what it is computed from ("-": nothing), and its turn
    when missing flags are filled (0: it starts the grouping key)."""

    name: str
    kind: str
    source: str
    turn: int | None

    @property
    def type(self) -> T.DataType:
        if self.name == "id":
            return T.LongType()
        return {"key": T.StringType(), "text": T.StringType(), "target": T.IntegerType()}.get(self.kind, T.DoubleType())


# The columns of the raw record file in file order; the spellings (Degits, Degit, Spacial)
# are part of the contract. Each filled flag joins the grouping key of the next, so the turns change results.
FIELDS = tuple(
    Field(name, kind, source, int(turn[0]) if turn else None)
    for name, kind, source, *turn in map(str.split, """
    id                          key     -
    FILENAME                    key     -
    URL                         text    -
    URLLength                   count   url
    Domain                      text    -
    DomainLength                count   url
    IsDomainIP                  flag    url    1
    TLD                         text    -
    CharContinuationRate        real    url
    TLDLegitimateProb           real    url
    URLCharProb                 real    url
    TLDLength                   count   url
    NoOfSubDomain               count   url
    HasObfuscation              flag    url    0
    NoOfObfuscatedChar          count   url
    ObfuscationRatio            real    url
    NoOfLettersInURL            count   url
    LetterRatioInURL            real    url
    NoOfDegitsInURL             count   url
    DegitRatioInURL             real    url
    NoOfEqualsInURL             count   url
    NoOfQMarkInURL              count   url
    NoOfAmpersandInURL          count   url
    NoOfOtherSpecialCharsInURL  count   url
    SpacialCharRatioInURL       real    url
    IsHTTPS                     flag    url    2
    LineOfCode                  count   page
    LargestLineLength           count   page
    HasTitle                    flag    title  3
    Title                       text    -
    DomainTitleMatchScore       real    title
    URLTitleMatchScore          real    title
    HasFavicon                  flag    page   12
    Robots                      flag    page   7
    IsResponsive                flag    page   4
    NoOfURLRedirect             flag    page   17
    NoOfSelfRedirect            flag    page   15
    HasDescription              flag    page   9
    NoOfPopup                   count   page
    NoOfiFrame                  count   page
    HasExternalFormSubmit       flag    page   11
    HasSocialNet                flag    page   18
    HasSubmitButton             flag    page   13
    HasHiddenFields             flag    page   6
    HasPasswordField            flag    page   14
    Bank                        flag    page   10
    Pay                         flag    page   5
    Crypto                      flag    page   8
    HasCopyrightInfo            flag    page   16
    NoOfImage                   count   page
    NoOfCSS                     count   page
    NoOfJS                      count   page
    NoOfSelfRef                 count   page
    NoOfEmptyRef                count   page
    NoOfExternalRef             count   page
    label                       target  -
    """.strip().splitlines())
)


def _names(*kinds: str, source: str | None = None) -> tuple[str, ...]:
    return tuple(f.name for f in FIELDS if (not kinds or f.kind in kinds) and source in (None, f.source))


RAW = _names()
IDENTIFIERS, TEXT, (TARGET,) = _names("key"), _names("text"), _names("target")
WORKING = _names("text", "flag", "real", "count")
FEATURES, BINARY, CONTINUOUS, COUNTS = _names("flag", "real", "count"), _names("flag"), _names("real"), _names("count")
NUMERIC = _names("real", "count")
URL_FEATURES, TITLE_FEATURES, PAGE_FEATURES = (_names(source=x) for x in ("url", "title", "page"))
_TURNS = sorted((f.turn, f.name) for f in FIELDS if f.turn is not None)
CASCADE_KEY = tuple(name for turn, name in _TURNS if turn == 0)
CASCADE_ORDER = tuple(name for turn, name in _TURNS if turn)

# Class labels, the constant-predictor accuracy, provenance words.
PHISHING = 0
LEGITIMATE = 1
MAJORITY_ACCURACY = 0.9248
FROM_URL, SCRAPED, IMPUTED, DEMOTED = "url", "scraped", "imputed", "demoted"

RAW_SCHEMA = T.StructType([T.StructField(f.name, f.type) for f in FIELDS])


class ContractError(ValueError):
    """A column the contract names is absent, or a label breaks its rule."""


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    """Names in ``required`` that the frame lacks, sorted. Reads the schema only."""
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    absent = missing_columns(df, required)
    if absent:
        raise ContractError(f"missing columns: {absent}")
    return df


def add_missing_text(df: DataFrame, names: Sequence[str] = TEXT) -> DataFrame:
    """Add absent text columns as NULL strings."""
    absent = [c for c in names if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else df


def label_problems(df: DataFrame, label: str = TARGET) -> DataFrame:
    """One row: how many labels are NULL, and the sorted distinct values outside {0, 1}.

    The distinct set is of label values, which is small for a label column; the
    aggregate is partial on the map side.
    """
    bad = F.col(label).isNotNull() & ~F.col(label).isin(0, 1)
    return df.agg(
        F.count_if(F.col(label).isNull()).alias("missing_labels"),
        F.count_if(bad).alias("unexpected_rows"),
        F.min(F.when(bad, F.col(label))).alias("min_unexpected"),
        F.max(F.when(bad, F.col(label))).alias("max_unexpected"),
    )


def unexpected_labels(df: DataFrame, label: str = TARGET) -> DataFrame:
    """The distinct labels other than 0 and 1, in order."""
    return df.select(label).filter(~F.col(label).isin(0, 1)).distinct().orderBy(label)


def check_labels(df: DataFrame, label: str = TARGET) -> DataFrame:
    found = label_problems(df, label).first()
    if found["missing_labels"]:
        raise ContractError(f"{found['missing_labels']} row(s) have no label")
    if found["unexpected_rows"]:
        ends = unexpected_labels(df, label).agg(F.count("*").alias("n"), F.min(label).alias("least"), F.max(label).alias("greatest")).first()
        raise ContractError(
            f"{found['unexpected_rows']} row(s) have labels outside {{0, 1}}: {ends['n']} label(s) from {ends['least']} to {ends['greatest']}; "
            "unexpected_labels() gives them all"
        )
    return df


def split_record(df: DataFrame) -> DataFrame:
    """The working columns, without identifiers and target."""
    return df.drop(*IDENTIFIERS, TARGET)


def to_feature_order(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Exactly the keys and the 49 features, in contract order."""
    return require_columns(df, (*keys, *FEATURES)).select(*keys, *FEATURES)
