"""Addresses by a table of blocks against the row-local classes and plain containment."""

import ipaddress
import random

from pyspark.sql import functions as F

from urlsift.functions import addresses
from urlsift.operators import admission
from urlsift.operators import intervals as I

ODD = ["127.0.0.1", "::1", "::ffff:127.0.0.1", "::ffff:8.8.8.8", "fe80::1", "1.2.3.256", "host.test", "", None, "0.0.0.0", "255.255.255.255", "::", "2001:db8::", "64:ff9b::1"]


def addresses_of(n):
    rng = random.Random(1)
    four = [str(ipaddress.IPv4Address(rng.getrandbits(32))) for _ in range(n)] + [f"{rng.choice([10, 100, 127, 169, 172, 192, 198, 203, 224])}.{rng.randint(0, 255)}.{rng.randint(0, 255)}.1" for _ in range(n)]
    six = [str(ipaddress.IPv6Address(rng.getrandbits(128))) for _ in range(n)] + [f"2001:{rng.randint(0, 0xfff):x}::{k:x}" for k in range(n)]
    return four + six + ODD


def test_fixed_classes(spark):
    rows = spark.createDataFrame(list(enumerate(addresses_of(200))), "i int, a string")
    got = {r.i: r.reason for r in I.with_reason(rows, I.block_table(I.fixed_blocks(spark)), "a").collect()}
    assert got == {r.i: r.w for r in rows.select("i", addresses.address_reason(F.col("a")).alias("w")).collect()}


def test_random_blocks(spark):
    rng = random.Random(2)
    blocks = [(f"{ipaddress.IPv4Address(rng.getrandbits(32))}/{rng.choice([0, 3, 8, 11, 16, 23, 24, 30, 32])}", rng.choice("abc"), rng.choice([False, False, True])) for _ in range(150)]
    blocks += [("10.0.0.7", "a", False), ("no block", "a", False), (None, "b", False)]
    rank = {"a": 0, "b": 1, "c": 2}
    table = I.block_table(spark.createDataFrame([(b, r, rank[r], e) for b, r, e in blocks], "block string, reason string, rank int, exempt boolean"))
    asked = [a for a in addresses_of(60) if a and a.count(".") == 3 and ":" not in a and "256" not in a.split(".")]
    nets = [(ipaddress.ip_network(b, strict=False), r, e) for b, r, e in blocks if b and b != "no block"]

    def want(a):
        met = [(r, e) for n, r, e in nets if ipaddress.ip_address(a) in n]
        held = [r for r, e in met if not e and (r, True) not in met]
        return min(held, default=None)

    got = {r.a: r.reason for r in I.with_reason(spark.createDataFrame([(a,) for a in asked], "a string"), table, "a").collect()}
    assert got == {a: want(a) for a in asked}


def test_empty_sides(spark):
    none = spark.createDataFrame([], "block string, reason string, rank int, exempt boolean")
    rows = spark.createDataFrame([("10.0.0.1",), ("::ffff:1.2.3.4",)], "a string")
    assert {(r.a, r.reason) for r in I.with_reason(rows, I.block_table(none), "a").collect()} == {("10.0.0.1", None), ("::ffff:1.2.3.4", "ipv4_mapped")}
    assert I.with_reason(rows.limit(0), I.block_table(none), "a").collect() == []


def test_deny_entries_in_any_form(spark):
    rows = spark.createDataFrame([(1, "http://bücher.test/"), (2, "http://evil.test./"), (3, "http://a.EVIL.test/"), (4, "http://notevil.test/")], "i int, u string")
    deny = ["Bücher.test", "evil.test."]
    got = {r.i: r.why for r in rows.select("i", admission.admission_reason(F.col("u"), deny).alias("why")).collect()}
    assert got == {1: "host_denied", 2: "host_denied", 3: "host_denied", 4: None}
    hosts = rows.select("i", F.regexp_extract("u", "//([^/]*)", 1).alias("host"))
    assert {r.i for r in admission.denied_rows(hosts, spark.createDataFrame([(d,) for d in deny], "host string"), "i").collect()} == {1, 2, 3}
