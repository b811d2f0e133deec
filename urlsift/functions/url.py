"""URL string features as Column expressions.

Every function takes Columns and returns a Column; nothing here starts a job or
leaves the JVM. Lengths count characters. A NULL input gives NULL unless the
rule says otherwise. The same expressions serve a table of any size and a single
row, so there is no separate row-level version to keep in step.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import lru_cache
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# An optional scheme, then the authority after "//"; leading blanks are ignored.
_AUTHORITY = r"^[\x00-\x20]*(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)"
_PATH = r"^[\x00-\x20]*(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _count(url: Column, piece: str) -> Column:
    return F.length(url) - F.length(F.replace(url, F.lit(piece), F.lit("")))


def _kept(url: Column, drop_pattern: str) -> Column:
    """How many characters survive removing the pattern."""
    return F.length(F.regexp_replace(url, drop_pattern, ""))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole.cast("double"))


def _single_line(url: Column) -> Column:
    return F.translate(url, "\t\r\n", "")


def url_length(url):
    return F.length(_col(url))


def domain(url):
    """Network location with user-info and port; '' when there is no authority."""
    return F.regexp_extract(_single_line(_col(url)), _AUTHORITY, 1)


def url_path(url):
    path = F.regexp_extract(_single_line(_col(url)), _PATH, 1)
    return F.regexp_replace(path, ";[^/]*$", "")


def is_domain_ip(dom):
    dom = _col(dom)
    octets_fit = F.forall(F.split(dom, r"\."), lambda p: p.try_cast("int") <= 255)
    quad = dom.rlike(r"^(\d{1,3}\.){3}\d{1,3}$")
    return F.when(dom.isNotNull(), F.when(quad, F.when(octets_fit, 1).otherwise(0)).otherwise(0))


def tld(dom):
    parts = F.split(_col(dom), r"\.")
    return F.when(F.size(parts) > 1, F.element_at(parts, -1))


def subdomain_count(dom):
    dom = _col(dom)
    return F.when(dom.isNotNull(), F.greatest(_count(dom, ".") - 1, F.lit(0)))


def continuation_rate(url):
    url = _col(url)
    return _ratio(_kept(url, "[^a-zA-Z0-9_]"), F.length(url))


def has_obfuscation(url):
    """1 when any of five string rules fires, 0 otherwise; 0 for a NULL URL."""
    url = _col(url)
    n = F.length(url)
    fires = (
        ((n - _kept(url, "[-_]")) > 3)
        | url.rlike(r"[a-zA-Z]\d|\d[a-zA-Z]")
        | ((n % 4 == 0) & url.rlike(r"^[A-Za-z0-9+/]*={0,2}\z"))
        | url.rlike(r"^[a-zA-Z0-9.\-]+$")
        | ~url.rlike("[a-zA-Z]{3}")
    )
    return F.when(fires, 1).otherwise(0)


def obfuscation_rules(url):
    """The five rules one by one, as a struct of 0/1 flags."""
    url = _col(url)
    n = F.length(url)

    def flag(cond, name):
        return F.when(cond, 1).otherwise(0).alias(name)

    return F.struct(
        flag((n - _kept(url, "[-_]")) > 3, "many_dashes"),
        flag(url.rlike(r"[a-zA-Z]\d|\d[a-zA-Z]"), "mixed_alnum"),
        flag((n % 4 == 0) & url.rlike(r"^[A-Za-z0-9+/]*={0,2}\z"), "base64_shape"),
        flag(url.rlike(r"^[a-zA-Z0-9.\-]+$"), "bare_name"),
        flag(~url.rlike("[a-zA-Z]{3}"), "no_letter_run"),
    )


def obfuscated_chars(url):
    url = _col(url)
    escapes = (F.length(url) - _kept(url, "%[0-9a-fA-F]{2}")) / 3
    return (escapes + _count(url, "@")).cast("int")


def letters(url):
    return _kept(_col(url), r"[^\p{L}]")


@lru_cache(maxsize=1)
def _other_digits() -> str:
    """Ranges of the characters that count as digits without being decimal."""
    odd = [i for i in range(0x80, 0x110000) if chr(i).isdigit() and not chr(i).isdecimal()]
    runs = groupby(enumerate(odd), key=lambda x: x[1] - x[0])
    ends = [(part[0][1], part[-1][1]) for part in (list(run) for _, run in runs)]
    return "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in ends)


def digits(url):
    return _kept(_col(url), rf"[^\p{{Nd}}{_other_digits()}]")


def digit_ratio(url):
    return _ratio(digits(url), F.length(_col(url)))


def equals_signs(url):
    return _count(_col(url), "=")


def question_marks(url):
    return _count(_col(url), "?")


def ampersands(url):
    return _count(_col(url), "&")


def special_chars(url):
    return _kept(_col(url), r"[0-9A-Za-z\u212A]")


def special_ratio(url):
    return _ratio(special_chars(url), F.length(_col(url)))


def is_https(url):
    url = _col(url)
    return F.when(url.isNotNull(), F.when(F.contains(url, F.lit("https://")), 1).otherwise(0))


def char_prob(url, probs: Mapping[str, float]):
    """Sum of the fitted share of every alphanumeric character, over the length.

    ASCII characters index an array literal by code point; the rare others go
    through a map. The share table has one entry per distinct character of the
    alphabet, so it is bounded by the alphabet and not by the data.
    """
    url = _col(url)
    ascii_share = F.array(*[F.lit(float(probs.get(chr(i), 0.0))) for i in range(128)])
    wide = {c: p for c, p in probs.items() if ord(c) > 127}
    if wide:
        wide_map = F.create_map(*[F.lit(v) for item in sorted(wide.items()) for v in item])
        wide_share = lambda c: F.coalesce(F.element_at(wide_map, c), F.lit(0.0))
    else:
        wide_share = lambda c: F.lit(0.0)

    def share(c):
        code = F.ascii(c)
        return F.when(code < 128, F.get(ascii_share, code)).otherwise(wide_share(c))

    chars = F.split(F.lower(url), "")
    total = F.aggregate(chars, F.lit(0.0), lambda acc, c: acc + share(c))
    return F.when(F.length(url) > 0, total / F.length(url))


def match_score(title: Column, base_text: Column) -> Column:
    """Fold over title words: a word found in the remaining text adds its share of
    100 points and is removed from the text; the score is held at 100."""
    share = F.when(F.length(base_text) > 0, F.lit(100.0) / F.length(base_text)).otherwise(F.lit(0.0))

    def step(state, word):
        hit = F.contains(state["rest"], word)
        gained = state["score"] + state["share"] * F.length(word)
        capped = F.when(gained > 99.9, F.lit(100.0)).otherwise(gained)
        return F.struct(
            F.when(hit, F.replace(state["rest"], word, F.lit(""))).otherwise(state["rest"]).alias("rest"),
            F.when(hit, capped).otherwise(state["score"]).alias("score"),
            state["share"].alias("share"),
        )

    start = F.struct(base_text.alias("rest"), F.lit(0.0).alias("score"), share.alias("share"))
    return F.aggregate(F.split(title, " "), start, step, lambda s: s["score"])


def _all_but_last(parts: Column) -> Column:
    return F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))


def _domain_text(dom: Column) -> Column:
    return F.array_join(F.filter(_all_but_last(F.split(dom, r"\.")), lambda p: p != "www"), ".")


def domain_title_score(title, dom):
    title, dom = _col(title), _col(dom)
    return F.when(title.isNotNull() & dom.isNotNull(), match_score(title, _domain_text(dom)))


def url_title_score(title, url):
    title, url = _col(title), _col(url)
    host = _all_but_last(F.split(domain(url), r"\."))
    path = F.filter(F.split(url_path(url), "/"), lambda p: p != "")
    text = F.array_join(F.filter(F.concat(host, path), lambda p: p != "www"), ".")
    return F.when(title.isNotNull() & url.isNotNull(), match_score(title, text))


def url_feature_columns(url: str = "URL", dom: str = "Domain", tld_col: str = "TLD") -> dict[str, Column]:
    """Every feature the URL string alone decides (no fitted statistic needed)."""
    return {
        "URLLength": url_length(url),
        "DomainLength": F.length(dom),
        "IsDomainIP": is_domain_ip(dom),
        "CharContinuationRate": continuation_rate(url),
        "TLDLength": F.length(tld_col),
        "NoOfSubDomain": subdomain_count(dom),
        "HasObfuscation": has_obfuscation(url),
        "NoOfObfuscatedChar": obfuscated_chars(url),
        "ObfuscationRatio": _ratio(obfuscated_chars(url), url_length(url)),
        "NoOfLettersInURL": letters(url),
        "LetterRatioInURL": _ratio(letters(url), url_length(url)),
        "NoOfDegitsInURL": digits(url),
        "DegitRatioInURL": digit_ratio(url),
        "NoOfEqualsInURL": equals_signs(url),
        "NoOfQMarkInURL": question_marks(url),
        "NoOfAmpersandInURL": ampersands(url),
        "NoOfOtherSpecialCharsInURL": special_chars(url),
        "SpacialCharRatioInURL": special_ratio(url),
        "IsHTTPS": is_https(url),
    }


def url_features(df: DataFrame, url: str = "URL") -> DataFrame:
    """Add Domain, TLD and the URL-only features to a frame that holds URLs."""
    staged = df.withColumn("Domain", domain(url)).withColumn("TLD", tld("Domain"))
    return staged.withColumns(url_feature_columns(url))


def fill_url_features(df: DataFrame, probs: Mapping[str, float] | None) -> DataFrame:
    """Fill the URL-derived columns of raw records; a present value is kept.

    The order of the three stages is the dependency order: the domain before what
    is read from it, and the filled length and counts before the ratios built on
    them. TLDLegitimateProb needs a fitted table and is filled by the transform.
    """

    def keep(name, expr):
        return F.coalesce(F.col(name), expr.cast("double"))

    first = {
        "Domain": F.coalesce("Domain", domain("URL")),
        "URLLength": keep("URLLength", url_length("URL")),
        "CharContinuationRate": keep("CharContinuationRate", continuation_rate("URL")),
        "HasObfuscation": F.when(
            F.coalesce("HasObfuscation", has_obfuscation("URL")) == 1, 1.0
        ).otherwise(0.0),
        "NoOfObfuscatedChar": keep("NoOfObfuscatedChar", obfuscated_chars("URL")),
        "NoOfLettersInURL": keep("NoOfLettersInURL", letters("URL")),
        "NoOfDegitsInURL": keep("NoOfDegitsInURL", digits("URL")),
        "DegitRatioInURL": keep("DegitRatioInURL", digit_ratio("URL")),
        "NoOfEqualsInURL": keep("NoOfEqualsInURL", equals_signs("URL")),
        "NoOfQMarkInURL": keep("NoOfQMarkInURL", question_marks("URL")),
        "NoOfAmpersandInURL": keep("NoOfAmpersandInURL", ampersands("URL")),
        "NoOfOtherSpecialCharsInURL": keep("NoOfOtherSpecialCharsInURL", special_chars("URL")),
        "SpacialCharRatioInURL": keep("SpacialCharRatioInURL", special_ratio("URL")),
        "IsHTTPS": keep("IsHTTPS", is_https("URL")),
        "HasTitle": keep("HasTitle", F.when(F.col("Title").isNotNull(), 1)),
        "URLTitleMatchScore": keep("URLTitleMatchScore", url_title_score("Title", "URL")),
    }
    if probs is not None:
        first["URLCharProb"] = keep("URLCharProb", char_prob("URL", probs))
    second = {
        "DomainLength": keep("DomainLength", F.length("Domain")),
        "IsDomainIP": keep("IsDomainIP", is_domain_ip("Domain")),
        "TLD": F.coalesce("TLD", tld("Domain")),
        "NoOfSubDomain": keep("NoOfSubDomain", subdomain_count("Domain")),
        "ObfuscationRatio": keep(
            "ObfuscationRatio", _ratio(F.col("NoOfObfuscatedChar"), F.col("URLLength"))
        ),
        "LetterRatioInURL": keep(
            "LetterRatioInURL", _ratio(F.col("NoOfLettersInURL"), F.col("URLLength"))
        ),
        "DomainTitleMatchScore": keep("DomainTitleMatchScore", domain_title_score("Title", "Domain")),
    }
    third = {"TLDLength": keep("TLDLength", F.length("TLD"))}
    return df.withColumns(first).withColumns(second).withColumns(third)
