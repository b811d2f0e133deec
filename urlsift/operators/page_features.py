"""The page features: row-local expressions over a page's text and elements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlsift import constants as K
from urlsift import contract as C
from urlsift.functions import hosts as H
from urlsift.functions import text as X
from urlsift.operators.elements import scan_pages


def _tags(*names: str) -> Column:
    elements = F.col("elements")
    if len(names) == 1:
        return F.filter(elements, lambda e: e["tag"] == names[0])
    return F.filter(elements, lambda e: e["tag"].isin(list(names)))


def _attr(e: Column, name: str) -> Column:
    return F.coalesce(F.element_at(e["attrs"], F.lit(name)), F.lit(""))


def _has(e: Column, name: str) -> Column:
    return F.map_contains_key(e["attrs"], name)


def _rel_tokens(e: Column) -> Column:
    return F.split(F.lower(X.strip(_attr(e, "rel"))), r"\s+")


def _meta_content(attr: str, value: str) -> Column:
    """Content of the first meta whose attribute has the value; NULL when blank."""
    first = F.get(F.filter(_tags("meta"), lambda e: _attr(e, attr) == value), 0)
    content = F.element_at(first["attrs"], F.lit("content"))
    return F.nullif(X.strip(content), F.lit(""))


def _flag(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)


def references(scope: str) -> Column:
    """All references in scope, as an array of texts ('' when the attribute is absent)."""

    def texts(tag, attr):
        return F.transform(_tags(tag), lambda e: _attr(e, attr))

    parts = [texts(*pair) for pair in K.REF_SCOPES[scope]]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def _is_empty_ref(ref: Column) -> Column:
    return F.lower(X.strip(ref)).isin(list(K.EMPTY_REFS))


def page_titles(df: DataFrame, html: str = "html") -> DataFrame:
    """The frame with the page text replaced by its Title."""
    return scan_pages(df, html).withColumnRenamed("title", "Title").drop("text", "footer", "elements")


def reference_counts(scope: str, sites: Column, refs: Column) -> dict[str, Column]:
    page_site = F.col("page_site")
    return {
        "NoOfSelfRef": F.size(F.filter(sites, lambda s: s == page_site)),
        "NoOfEmptyRef": F.size(F.filter(refs, _is_empty_ref)),
        "NoOfExternalRef": F.size(
            F.filter(sites, lambda s: s.isNotNull() & ~s.eqNullSafe(page_site))
        ),
    }


def page_features(
    df: DataFrame,
    *,
    keys: Sequence[str] = ("page_id",),
    html: str = "html",
    url: str = "url",
    redirects: str | None = None,
    robots: str | None = None,
    scope: str = "anchor",
    demoted: Sequence[str] = (),
    rules: Sequence[str] = K.SUFFIX_RULES,
    also: Sequence[str] = (),
) -> DataFrame:
    """Keys, Title, HasTitle and the 25 page features.

    Of each further scope in ``also`` the reference counts follow as ``<feature>_<scope>``, from the same reading of the page.

    A row without page text gets NULL for all of them: a count of zero is a
    measurement, an absent page is not. Demoted features are NULL always.
    """
    chain = F.col(redirects) if redirects else F.array().cast("array<string>")
    verdict = F.col(robots).cast("boolean") if robots else F.lit(None).cast("boolean")
    page = F.col(html)
    slim = df.select(
        *keys,
        F.col(url).alias("_url"),
        chain.alias("_chain"),
        verdict.alias("_robots"),
        X.line_lengths(page).alias("_lines"),
        F.right(page, F.lit(K.RAW_TAIL)).rlike("(?i)" + K.COPYRIGHT_PATTERN).alias("_raw_notice"),
        page.alias("_html"),
    ).withColumns(
        {"LineOfCode": X.line_count(F.col("_lines")), "LargestLineLength": X.longest_line(F.col("_lines"))}
    ).drop("_lines")
    scanned = scan_pages(slim, "_html").withColumns(
        {
            "text": F.lower("text"),
            "page_site": H.site_of_host(H.host_of_url(F.col("_url")), rules),
        }
    )

    def site(ref):
        return H.site_of_ref(ref, F.col("_url"), F.col("page_site"), rules)

    scripts = F.transform(_tags("script"), lambda e: F.coalesce(e["text"], F.lit("")))
    handlers = F.flatten(
        F.transform(
            F.col("elements"),
            lambda e: F.map_values(F.map_filter(e["attrs"], lambda k, v: F.startswith(k, F.lit("on")))),
        )
    )
    refreshes = F.filter(
        _tags("meta"),
        lambda e: (F.lower(X.strip(_attr(e, "http-equiv"))) == "refresh")
        & _attr(e, "content").rlike("(?i)" + K.META_REFRESH_PATTERN),
    )
    targets = F.transform(
        refreshes,
        lambda e: site(X.strip(F.regexp_extract(_attr(e, "content"), "(?i)" + K.META_REFRESH_PATTERN, 1))),
    )
    refs = references(scope)
    live = F.filter(references(scope), lambda r: ~_is_empty_ref(r))
    anchors = F.filter(
        F.transform(_tags("a"), lambda e: _attr(e, "href")), lambda r: X.strip(r) != ""
    )
    haystack = F.concat_ws(
        " ", F.col("text"), F.coalesce(F.lower("title"), F.lit("")), F.lower("_url")
    )
    prepared = scanned.withColumns(
        {
            "_popup": F.array_join(F.concat(scripts, handlers), "\n"),
            "_targets": F.concat(F.transform(F.col("_chain"), site), targets),
            "_refs": refs,
            "_ref_sites": F.transform(live, site),
            **{f"_refs_{s}": references(s) for s in also},
            **{f"_ref_sites_{s}": F.transform(F.filter(references(s), lambda r: ~_is_empty_ref(r)), site) for s in also},
            "_anchor_sites": F.transform(anchors, site),
            "_words": haystack,
            "_description": F.coalesce(
                _meta_content("name", "description"), _meta_content("property", "og:description")
            ),
            "_meta_robots": F.lower(F.coalesce(_meta_content("name", "robots"), F.lit(""))),
            "_viewport": F.lower(F.coalesce(_meta_content("name", "viewport"), F.lit(""))),
        }
    )
    site_col = F.col("page_site")

    def external_action(e):
        action = X.strip(_attr(e, "action"))
        return (action != "") & (action != "#") & (site(action) != site_col)

    def submits(e):
        kind = F.lower(_attr(e, "type")) == "submit"
        untyped = (e["tag"] == "button") & ~_has(e, "type") & e["in_form"]
        return kind | untyped

    def typed_input(kind):
        return F.exists(_tags("input"), lambda e: F.lower(_attr(e, "type")) == kind)

    notice = "(?i)" + K.COPYRIGHT_PATTERN
    values = {
        "HasTitle": _flag(F.col("title").isNotNull()),
        "LineOfCode": F.col("LineOfCode"),
        "LargestLineLength": F.col("LargestLineLength"),
        "HasFavicon": _flag(
            F.exists(
                _tags("link"),
                lambda e: F.arrays_overlap(_rel_tokens(e), F.array(*map(F.lit, K.ICON_RELS)))
                & (X.strip(_attr(e, "href")) != ""),
            )
        ),
        "Robots": F.coalesce(
            F.col("_robots").cast("int"),
            1 - _flag(F.contains("_meta_robots", F.lit("noindex")) | F.contains("_meta_robots", F.lit("none"))),
        ),
        "IsResponsive": _flag(
            F.contains("_viewport", F.lit("width="))
            | F.exists(_tags("style"), lambda e: F.contains(e["text"], F.lit("@media")))
        ),
        "NoOfURLRedirect": F.size("_targets"),
        "NoOfSelfRedirect": F.size(F.filter("_targets", lambda s: s == site_col)),
        "HasDescription": _flag(F.col("_description").isNotNull()),
        "NoOfPopup": sum(
            (F.regexp_count("_popup", F.lit("(?i)" + p)) for p in K.POPUP_PATTERNS), F.lit(0)
        ),
        "NoOfiFrame": F.size(_tags("iframe", "frame")),
        "HasExternalFormSubmit": _flag(F.exists(_tags("form"), external_action)),
        "HasSocialNet": _flag(F.exists("_anchor_sites", lambda s: s.isin(list(K.SOCIAL_DOMAINS)))),
        "HasSubmitButton": _flag(F.exists(_tags("input", "button"), submits)),
        "HasHiddenFields": _flag(typed_input("hidden")),
        "HasPasswordField": _flag(typed_input("password")),
        "Bank": _flag(X.has_any_term(F.col("_words"), K.BANK_TERMS)),
        "Pay": _flag(X.has_any_term(F.col("_words"), K.PAY_TERMS)),
        "Crypto": _flag(X.has_any_term(F.col("_words"), K.CRYPTO_TERMS)),
        "HasCopyrightInfo": _flag(
            F.right("text", F.lit(K.TEXT_TAIL)).rlike(notice)
            | F.col("footer").rlike(notice)
            | F.col("_raw_notice")
        ),
        "NoOfImage": F.size(_tags("img")),
        "NoOfCSS": F.size(
            F.filter(_tags("link"), lambda e: F.array_contains(_rel_tokens(e), "stylesheet"))
        ) + F.size(_tags("style")),
        "NoOfJS": F.size(_tags("script")),
        **reference_counts(scope, F.col("_ref_sites"), F.col("_refs")),
    }
    present = F.col("elements").isNotNull()
    columns = []
    for name in ("HasTitle", *C.PAGE_FEATURES):
        value = F.lit(None) if name in demoted else F.when(present, values[name])
        columns.append(value.cast("int").alias(name))
    for s in also:
        for name, value in reference_counts(s, F.col(f"_ref_sites_{s}"), F.col(f"_refs_{s}")).items():
            columns.append((F.lit(None) if name in demoted else F.when(present, value)).cast("int").alias(f"{name}_{s}"))
    return prepared.select(*keys, F.col("title").alias("Title"), *columns)
