"""Admission of URLs and of the addresses their hosts resolve to."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlsift import constants as K
from urlsift.functions.addresses import address_reason, is_address
from urlsift.functions.hosts import host_suffixes
from urlsift.functions.text import let, strip
from urlsift.operators.intervals import with_reason
from urlsift.operators.sites import ascii_name
from urlsift.runtime import lookup_join

_SPLIT = r"^([a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://([^/?#]*))?"


def url_parts(url: Column) -> dict[str, Column]:
    """scheme, authority, host and port text of a trimmed URL."""
    text = F.translate(strip(url), "\t\r\n", "")
    scheme = F.lower(F.rtrim(F.regexp_extract(text, _SPLIT, 1), F.lit(":")))
    authority = F.regexp_extract(text, _SPLIT, 2)
    after_user = F.regexp_replace(authority, "^.*@", "")
    bracketed = F.startswith(after_user, F.lit("["))
    host = F.when(bracketed, F.regexp_extract(after_user, r"^\[([^\]]*)\]", 1)).otherwise(
        F.regexp_replace(after_user, ":.*$", "")
    )
    port = F.when(bracketed, F.regexp_extract(after_user, r"^\[[^\]]*\](?::(.*))?$", 1)).otherwise(
        F.regexp_extract(after_user, "^[^:]*:(.*)$", 1)
    )
    return {"scheme": scheme, "authority": authority, "host": F.lower(host), "port": port}


def _idna(hosts: pa.Array) -> pa.Array:
    """The form of a host name that resolvers see; NULL for a name that has none."""
    out = []
    for host in hosts.to_pylist():
        try:
            out.append(None if host is None else host.encode("idna").decode("ascii").lower())
        except UnicodeError:
            out.append(None)
    return pa.array(out, pa.string())


def ascii_host(host: Column) -> Column:
    """The host as resolvers see it. Plain names stay as they are, even those with odd labels; others are
    encoded, and NULL where that fails."""
    plain = host.rlike(r"^[\x00-\x7F]*$")
    return F.when(plain, host).otherwise(F.arrow_udf(_idna, "string")(F.when(~plain, host)))


def is_denied(host: Column, deny: Sequence[str]) -> Column:
    """Whether the host or a parent of it is on a deny list, which becomes a literal set. Names of the list are taken in the form
    resolvers see, as the host is, and a dot at the end of either counts for nothing."""
    if not deny:
        return F.lit(False)
    names = [d for d in _idna(pa.array([d.lower().rstrip(".") for d in deny])).to_pylist() if d]
    return F.exists(host_suffixes(F.regexp_replace(host, r"\.$", "")), lambda s: s.isin(names))


def denied_rows(rows: DataFrame, deny: DataFrame, key: str, host: str = "host") -> DataFrame:
    """Keys whose host or a parent of it is in a deny table of any size.

    Every host is exploded into its few parents, once per distinct host, and looked
    up; of a long table the planner splits hot parents such as "com". Both sides are taken in the form resolvers see, without
    a dot at the end; a name that has no such form denies nothing and isn't denied.
    """
    hosts = rows.select(F.col(host).alias("_h")).distinct().withColumn("_n", ascii_name(F.col("_h")))
    parents = hosts.select("_h", F.explode(host_suffixes(F.col("_n"))).alias("host"))
    table = deny.select(ascii_name(F.col(deny.columns[0])).alias("host")).distinct().withColumn("_hit", F.lit(True))
    hit = lookup_join(parents, table, ["host"]).filter("_hit").select("_h").distinct()
    return lookup_join(
        rows.select(key, F.col(host).alias("_h")), hit.withColumn("_hit", F.lit(True)), ["_h"]
    ).filter("_hit").select(key)


def admission_reason(url: Column, deny: Sequence[str] = ()) -> Column:
    """The first rule the URL breaks, or NULL when it may be fetched."""
    def judge(p):
        port = p["port"].try_cast("int")
        bad_port = (p["port"] != "") & (~p["port"].rlike(r"^\d+$") | port.isNull() | (port > 65535))
        actual = F.when(p["port"] != "", port).when(p["scheme"] == "https", 443).otherwise(80)
        unclosed = F.contains(p["authority"], F.lit("[")) != F.contains(p["authority"], F.lit("]"))
        return (
            F.when(p["text"].isNull() | (p["text"] == ""), "empty_url")
            .when(F.length(p["text"]) > K.MAX_URL_LENGTH, "url_too_long")
            .when(unclosed, "unparseable_url")
            .when(~p["scheme"].isin(list(K.ALLOWED_SCHEMES)), "scheme_not_allowed")
            .when(F.contains(p["authority"], F.lit("@")), "credentials_in_url")
            .when(p["host"] == "", "missing_host")
            .when(p["ascii"].isNull(), "invalid_hostname")
            .when(bad_port, "invalid_port")
            .when(~actual.isin(list(K.ALLOWED_PORTS)), "port_not_allowed")
            .when(is_denied(p["ascii"], deny), "host_denied")
        )

    parts = {"text": strip(url), **url_parts(url)}
    parts["ascii"] = ascii_host(parts["host"])
    return let(F.struct(*[e.alias(n) for n, e in parts.items()]), judge)


def vet_resolved(
    urls: DataFrame, dns: DataFrame, *, key: str, url: str = "url", deny: Sequence[str] = (),
    own: Sequence[str] = (), blocks: DataFrame | None = None,
) -> DataFrame:
    """Key, host, reason (NULL when admitted) and the pinned first address.

    ``dns`` has host, ord, ip; a row without an ip says that the host resolved to nothing. Every address of a host must be permissible; the
    first offending one in order gives the reason. Resolution is reduced to one row
    per host before the lookup, and literal addresses need none. Addresses are judged by the fixed classes, or by a table of
    blocks of any length (``intervals.block_table``).
    """
    def verdict(ip, why):
        mine = ip.isin(list(own)) if own else F.lit(False)
        return F.when(ip.isNull(), "dns_no_records").when(mine, "own_address").otherwise(why)

    def reasoned(rows, address):
        return rows.withColumn("_class", address_reason(F.col(address))) if blocks is None else with_reason(rows, blocks, address, "_class")

    known = reasoned(dns.select(F.lower("host").alias("host"), "ord", "ip"), "ip")
    judged = known.select("host", "ord", "ip", verdict(F.col("ip"), F.col("_class")).alias("_why"))
    per_host = judged.groupBy("host").agg(
        F.min(F.when(F.col("_why").isNotNull(), F.struct("ord", "_why")))["_why"].alias("_bad"),
        F.min(F.struct("ord", "ip"))["ip"].alias("_first"),
        F.lit(True).alias("_known"),
    )
    parts = url_parts(F.col(url))
    staged = urls.select(key, F.coalesce(ascii_host(parts["host"]), parts["host"]).alias("host"), admission_reason(F.col(url), deny).alias("_rule"))
    joined = reasoned(lookup_join(staged, per_host, ["host"]).withColumn("_literal", is_address(F.col("host"))), "host")
    literal = F.col("_literal")
    why = (
        F.when(F.col("_rule").isNotNull(), F.col("_rule"))
        .when(literal, verdict(F.col("host"), F.col("_class")))
        .when(F.col("_known").isNull(), "dns_resolution_failed")
        .otherwise(F.col("_bad"))
    )
    pinned = F.when(literal, F.col("host")).otherwise(F.col("_first"))
    return joined.select(key, "host", why.alias("reason"), pinned.alias("_pin")).select(
        key, "host", "reason", F.when(F.col("reason").isNull(), F.col("_pin")).alias("ip")
    )
