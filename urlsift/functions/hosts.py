"""Hosts, registrable domains and site identity as Column expressions.

The suffix rules become a literal set in which a host's parents are looked up, so no host
leaves its row and nothing is joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from urlsift import constants as K
from urlsift.functions.text import let, strip

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_IPV4 = rf"^(?:{_OCTET}\.){{3}}{_OCTET}$"


def host_of_authority(authority: Column) -> Column:
    """Lower-case host: user-info, port and brackets removed; NULL when empty."""
    bare = F.regexp_replace(authority, "^.*@", "")
    bracketed = F.regexp_extract(bare, r"^\[([^\]]*)\]", 1)
    plain = F.regexp_replace(bare, ":.*$", "")
    host = F.when(F.startswith(bare, F.lit("[")), bracketed).otherwise(plain)
    return F.nullif(F.lower(host), F.lit(""))


def host_suffixes(host: Column) -> Column:
    """The host and every parent of it: a.b.c, b.c, c."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )


def _member(name: Column, names: Sequence[str]) -> Column:
    """Membership of a literal list of any length; the planner makes a hash set of it."""
    return name.isin(list(names)) if names else F.lit(False)


def registrable_domain(host: Column, rules: Sequence[str] = K.SUFFIX_RULES) -> Column:
    """``name.suffix`` under the longest matching suffix rule; NULL when no rule matches
    or the host is itself a suffix. An address is its own domain.

    The parents of the host are looked up from the longest on. A "*." rule covers one more
    label, a "!" rule takes a name out of such a rule.
    """
    plain = tuple(r for r in rules if r[0] not in "*!")
    wild = tuple(r[2:] for r in rules if r.startswith("*."))
    exceptions = tuple(r[1:] for r in rules if r.startswith("!"))

    def judge(parents):
        def is_suffix(s):
            covered = _member(F.regexp_replace(s, r"^[^.]+\.", ""), wild) & F.contains(s, F.lit("."))
            return _member(s, plain) | (covered & ~_member(s, exceptions))

        taken_out = F.filter(parents, lambda s: _member(s, exceptions))
        at = F.array_position(F.transform(parents, is_suffix), True)
        name = F.when(at > 1, F.get(parents, (at - 2).cast("int")))
        named = F.coalesce(F.get(taken_out, F.lit(0)), name) if exceptions else name
        # an empty label in front of the suffix is no name
        return F.when(~F.startswith(named, F.lit(".")), named)

    bare = F.regexp_replace(F.lower(host), r"\.$", "")
    address = host.rlike(_IPV4) | F.contains(host, F.lit(":"))
    return F.when(address, host).otherwise(let(host_suffixes(bare), judge))


def site_of_host(host: Column, rules: Sequence[str] = K.SUFFIX_RULES) -> Column:
    return F.coalesce(registrable_domain(host, rules), F.lower(host))


_SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.\-]*):"
_SCHEME_AUTH = r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)"


def _clean(ref: Column) -> Column:
    return F.regexp_replace(F.translate(ref, "\t\r\n", ""), r"^[\x00-\x20]+", "")


def host_of_url(url: Column) -> Column:
    """Host named by an absolute or scheme-relative URL, else NULL."""
    return host_of_authority(F.regexp_extract(_clean(url), _SCHEME_AUTH, 1))


def site_of(url_or_host: Column, rules: Sequence[str] = K.SUFFIX_RULES) -> Column:
    """Site of a URL or a bare host; NULL for schemes that name no host."""
    text = strip(url_or_host)
    has_authority = text.rlike(_SCHEME_AUTH)
    has_scheme = text.rlike(_SCHEME)
    bare = host_of_authority(F.regexp_extract(text, "^([^/?#]*)", 1))
    host = F.when(has_authority, host_of_url(text)).when(~has_scheme, bare)
    return site_of_host(host, rules)


def site_of_ref(ref: Column, page_url: Column, page_site: Column,
                rules: Sequence[str] = K.SUFFIX_RULES) -> Column:
    """Site a reference on a page leads to.

    Only the site matters, so no URL is joined: an authority names the site, a
    scheme without one names none, anything else stays on the page's own site.
    """
    ref = _clean(ref)
    scheme = F.lower(F.regexp_extract(ref, _SCHEME, 1))
    page_scheme = F.lower(F.regexp_extract(page_url, _SCHEME, 1))
    return (
        F.when(ref.rlike(r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//[^/?#]"), site_of_host(host_of_url(ref), rules))
        .when((scheme != "") & (scheme != page_scheme), F.lit(None).cast("string"))
        .otherwise(page_site)
    )


def resolve(base: Column, ref: Column) -> Column:
    """A location relative to the URL it came from, as an absolute URL."""
    ref = _clean(ref)
    origin = F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*", 0)
    folder = F.regexp_replace(F.regexp_replace(base, "[?#].*$", ""), r"^([^/]*//[^/]*)$", "$1/")
    return (
        F.when(ref.rlike(_SCHEME), ref)
        .when(F.startswith(ref, F.lit("//")), F.concat(F.regexp_extract(base, _SCHEME, 0), ref))
        .when(F.startswith(ref, F.lit("/")), F.concat(origin, ref))
        .otherwise(F.concat(F.regexp_replace(folder, "[^/]*$", ""), ref))
    )
