"""IP address classes as Column expressions over fixed-width hexadecimal text."""

from __future__ import annotations

import ipaddress

from pyspark.sql import Column
from pyspark.sql import functions as F

from urlsift import constants as K
from urlsift.functions.text import let

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IPV4 = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"


def is_ipv4(host: Column) -> Column:
    return host.rlike(IPV4)


def ipv4_number(host: Column) -> Column:
    """The address as a number; NULL for anything that is no dotted quad."""
    def number(text):
        return F.aggregate(
            F.split(text, r"\."), F.lit(0).cast("long"), lambda acc, p: acc * 256 + p.try_cast("long")
        )

    return let(host, lambda h: F.when(is_ipv4(h), number(h)))


def _groups(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ":"))


def _hex_groups(number: Column) -> Column:
    return F.concat(
        F.lower(F.hex(F.shiftright(number, 16))), F.lit(":"), F.lower(F.hex(number.bitwiseAND(65535)))
    )


def _expand(whole: Column) -> Column:
    """Digits of an address written in groups only."""
    has_gap = F.contains(whole, F.lit("::"))

    def filled(halves):
        left = _groups(F.get(halves, F.lit(0)))
        right = _groups(F.coalesce(F.get(halves, F.lit(1)), F.lit("")))
        return let(
            F.struct(left.alias("l"), right.alias("r"), (8 - F.size(left) - F.size(right)).alias("gap")),
            lambda s: F.when(
                F.when(has_gap, s["gap"] >= 1).otherwise(s["gap"] == 0) & (F.size(halves) <= 2),
                F.concat(s["l"], F.array_repeat(F.lit("0"), F.greatest(s["gap"], F.lit(0))), s["r"]),
            ),
        )

    digits = let(
        let(F.split(whole, "::"), filled),
        lambda g: F.when(
            F.forall(g, lambda x: x.rlike("^[0-9a-f]{1,4}$")),
            F.array_join(F.transform(g, lambda x: F.lpad(x, 4, "0")), ""),
        ),
    )
    return F.when(F.contains(whole, F.lit(":")), digits)


def ipv6_hex(host: Column) -> Column:
    """32 hexadecimal digits of an IPv6 address; NULL for anything else."""
    quad_at_end = r"\d{1,3}(?:\.\d{1,3}){3}$"

    def in_groups(text):
        tail = F.regexp_extract(text, quad_at_end, 0)
        return F.when(
            tail != "", F.concat(F.regexp_replace(text, quad_at_end, ""), let(ipv4_number(tail), _hex_groups))
        ).otherwise(text)

    def digits(text):
        return F.when(F.contains(text, F.lit(":")), let(in_groups(text), _expand))

    return let(F.lower(F.regexp_replace(host, "%.*$", "")), digits)


def _within(value: Column, block: str, wide: bool) -> Column:
    net = ipaddress.ip_network(block)
    first, last = int(net.network_address), int(net.broadcast_address)
    if wide:
        return value.between(f"{first:032x}", f"{last:032x}")
    return value.between(first, last)


def _ladder(value: Column, blocks, public, wide: bool) -> Column:
    found = None
    for reason, nets in blocks:
        hit = F.lit(False)
        for n in nets:
            hit = hit | _within(value, n, wide)
        if reason == "private_address":
            for n in public:
                hit = hit & ~_within(value, n, wide)
        found = F.when(hit, reason) if found is None else found.when(hit, reason)
    return found


def address_reason(host: Column) -> Column:
    """Why an address is no permissible destination; NULL for a public address and for
    text that is no address. The most specific reason comes first."""
    def v4(n):
        return _ladder(n, K.IPV4_BLOCKS, K.IPV4_PUBLIC, False)

    def v6(d):
        mapped = F.startswith(d, F.lit("0" * 20 + "ffff"))
        inner = F.conv(F.right(d, F.lit(8)), 16, 10).cast("long")
        return F.when(mapped, let(inner, lambda n: F.coalesce(v4(n), F.lit("ipv4_mapped")))).otherwise(
            _ladder(d, K.IPV6_BLOCKS, K.IPV6_PUBLIC, True)
        )

    return F.coalesce(let(ipv4_number(host), v4), let(ipv6_hex(host), v6))


def is_address(host: Column) -> Column:
    return is_ipv4(host) | ipv6_hex(host).isNotNull()
