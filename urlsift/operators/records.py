"""Records from URLs and pages, where each value came from, coverage and verdicts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlsift import constants as K
from urlsift import contract as C
from urlsift.operators.naive_bayes import NaiveBayes, log_density
from urlsift.operators.page_features import page_features


def build_records(
    crawl: DataFrame, *, key: str = "page_id", url: str = "url", final_url: str | None = "final_url",
    html: str = "html", outcome: str | None = "outcome", redirects: str | None = "redirects",
    robots: str | None = None, scope: str = "anchor", demoted: Sequence[str] = (),
) -> DataFrame:
    """Raw records: key, the working columns, NULL for whatever is not known.

    URL features stay NULL; the transform derives them, as it does in training. Page
    features are read only where the attempt succeeded and brought a page. The page
    step runs on the crawl rows themselves, so nothing is joined back.
    """
    fetched = F.col(outcome) == "ok" if outcome else F.lit(True)
    target = F.coalesce(F.nullif(F.col(final_url), F.lit("")), F.col(url)) if final_url else F.col(url)
    ready = crawl.select(
        F.col(key), F.col(url).alias("URL"), target.alias("_target"),
        F.when(fetched & (F.col(html) != ""), F.col(html)).alias("_page"),
        *([F.col(redirects).alias("_hops")] if redirects else []),
        *([F.col(robots).alias("_allowed")] if robots else []),
    )
    features = page_features(
        ready, keys=(key, "URL"), html="_page", url="_target",
        redirects="_hops" if redirects else None, robots="_allowed" if robots else None,
        scope=scope, demoted=demoted,
    )
    columns = [F.col(key)]
    for c in C.WORKING:
        if c in ("URL", "Title"):
            columns.append(F.col(c))
        elif c in C.PAGE_FEATURES:
            columns.append(F.col(c).cast("double").alias(c))
        elif c in C.TEXT:
            columns.append(F.lit(None).cast("string").alias(c))
        else:
            columns.append(F.lit(None).cast("double").alias(c))
    return features.select(*columns)


def provenance_columns(demoted: Sequence[str] = ()) -> dict[str, Column]:
    """Where each feature's value comes from, judged on the record before the transform.

    Demoted features stay demoted; URL features of a row with a URL come from the
    URL; the title-dependent ones are scraped if there is a title; of the rest a
    missing value will be imputed and a present one was scraped.
    """
    out = {}
    for c in C.FEATURES:
        if c in demoted:
            source = F.lit(C.DEMOTED)
        elif c in C.URL_FEATURES:
            source = F.when(F.col("URL").isNotNull() | F.col(c).isNotNull(), C.FROM_URL).otherwise(C.IMPUTED)
        elif c in C.TITLE_FEATURES:
            source = F.when(F.col("Title").isNotNull(), C.SCRAPED).otherwise(C.IMPUTED)
        else:
            source = F.when(F.col(c).isNotNull(), C.SCRAPED).otherwise(C.IMPUTED)
        out[c] = source
    return out


def provenance(records: DataFrame, key: str = "page_id", demoted: Sequence[str] = ()) -> DataFrame:
    """Key and a map feature -> source."""
    found = provenance_columns(demoted)
    names = F.array(*[F.lit(c) for c in found])
    return records.select(key, F.map_from_arrays(names, F.array(*found.values())).alias("provenance"))


def provenance_long(records: DataFrame, key: str = "page_id", demoted: Sequence[str] = ()) -> DataFrame:
    return provenance(records, key, demoted).select(
        key, F.explode("provenance").alias("feature", "source")
    )


def initial_provenance(records: DataFrame, key: str = "page_id", demoted: Sequence[str] = ()) -> DataFrame:
    """Sources as the record builder states them, before missing values are relabelled:
    every URL feature counts as coming from the URL."""
    found = provenance_columns(demoted) | {
        c: F.lit(C.FROM_URL) for c in C.URL_FEATURES if c not in demoted
    }
    names = F.array(*[F.lit(c) for c in found])
    return records.select(key, F.map_from_arrays(names, F.array(*found.values())).alias("provenance"))


def coverage_columns(sources: Column) -> dict[str, Column]:
    """Scraped page features over the obtainable ones; demoted features do not count."""
    page = F.array(*[F.element_at(sources, F.lit(c)) for c in C.PAGE_FEATURES])
    total = F.size(F.filter(page, lambda s: s != C.DEMOTED))
    scraped = F.size(F.filter(page, lambda s: s == C.SCRAPED))
    return {
        "scraped": scraped,
        "obtainable": total,
        "coverage": F.when(total > 0, scraped / total).otherwise(0.0),
    }


def coverage(provenance_df: DataFrame) -> DataFrame:
    return provenance_df.withColumns(coverage_columns(F.col("provenance")))


def abstain(covered: DataFrame, minimum: float = K.COVERAGE_MIN) -> DataFrame:
    """Flag rows with too little page evidence, with the reason."""
    short = F.col("coverage") < F.lit(minimum)
    text = F.concat(
        F.col("scraped").cast("string"), F.lit(" of "), F.col("obtainable").cast("string"),
        F.lit(f" page features read, below the {minimum:.0%} threshold"),
    )
    return covered.withColumns({"abstained": short, "abstain_reason": F.when(short, text).otherwise("")})


def verdict_columns(families: dict[str, Sequence[str]], abstained: Column) -> dict[str, Column]:
    """Consensus by family: the variants of a family must agree, then the families must.

    ``families`` maps a family to its label columns. Row-local, as the variants of
    one row sit side by side.
    """
    def agreed(columns):
        first = F.col(columns[0])
        same = F.lit(True)
        for c in columns[1:]:
            same = same & (F.col(c) == first)
        return F.when(same, first)

    decided = [agreed(list(cols)) for cols in families.values()]
    same = F.lit(True)
    for d in decided:
        same = same & d.isNotNull() & (d == decided[0])
    word = F.when(decided[0] == C.PHISHING, "phishing").otherwise("legitimate")
    consensus = F.when(~abstained & same, word)
    return {
        "consensus": consensus,
        "verdict": F.when(abstained, "insufficient evidence").otherwise(F.coalesce(consensus, F.lit("split"))),
    }


def feature_inspector(
    scored: DataFrame, reference: DataFrame, model: NaiveBayes, keys: Sequence[str]
) -> DataFrame:
    """Long form, one row per record and feature: value, training median, distance to each
    class in deviations, and the log-density difference that favours class 0.

    ``reference`` has one row per feature (see the profile module). It is as long as
    the feature list, so it is broadcast.
    """
    items = []
    for i, c in enumerate(model.features):
        v = F.col(c).cast("float").cast("double")
        gain = log_density(model, 0, i, v) - log_density(model, 1, i, v)
        items.append(F.struct(F.lit(c).alias("feature"), v.alias("value"), gain.alias("contribution")))
    long = scored.select(*keys, F.explode(F.array(*items)).alias("f")).select(*keys, "f.*")
    joined = long.join(
        F.broadcast(reference.select("feature", "median", "mean_phishing", "std_phishing",
                                     "mean_legitimate", "std_legitimate")), "feature"
    )

    def z(side):
        std = F.col(f"std_{side}")
        return (F.col("value") - F.col(f"mean_{side}")) / F.when(std == 0, 1.0).otherwise(std)

    return joined.select(
        *keys, "feature", "value", "median", z("phishing").alias("z_phishing"),
        z("legitimate").alias("z_legitimate"), "contribution",
    )
