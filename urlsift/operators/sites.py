"""Site identity by a table of suffix rules of any length.

Rules are rows (name, kind); distinct hosts meet them by their suffixes in one equi-join, and the longest match of
each host is an aggregate. No rule becomes part of a plan. For short lists ``functions.hosts`` does the same row-locally.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urlsift.functions import hosts as H
from urlsift.functions.text import strip
from urlsift.runtime import small, written

PLAIN, WILD, EXCEPTION = "plain", "wild", "exception"


def ascii_name(name: Column) -> Column:
    """A lower-case name in the form resolvers see, its trailing dot removed; NULL where it has none. Plain names never leave the JVM."""

    @F.arrow_udf("string")
    def encoded(names: pa.Array) -> pa.Array:
        def one(n: str | None) -> str | None:
            try:
                return n and n.encode("idna").decode("ascii").lower()
            except UnicodeError:
                return None

        return pa.array([one(n) for n in names.to_pylist()], pa.string())

    bare = F.regexp_replace(F.lower(strip(name)), r"\.$", "")
    return F.when(bare.rlike(r"^[\x00-\x7f]*$"), bare).otherwise(encoded(F.when(~bare.rlike(r"^[\x00-\x7f]*$"), bare)))


def rule_table(lines: DataFrame, text: str = "value") -> DataFrame:
    """(name, kind) from rules written one to a line: blanks and lines that begin with "//" are passed over, what follows a blank is no
    part of a rule. "*.x" covers one label more than x, "!x" takes x out of such a rule. Repeated rules count once."""
    rule = F.lower(F.regexp_extract(strip(F.col(f"`{text}`").cast("string")), r"^\S+", 0))
    rules = lines.select(rule.alias("rule")).filter((F.col("rule") != "") & ~F.startswith("rule", F.lit("//")))
    kind = F.when(F.startswith("rule", F.lit("*.")), WILD).when(F.startswith("rule", F.lit("!")), EXCEPTION).otherwise(PLAIN)
    named = rules.select(ascii_name(F.regexp_replace("rule", r"^(\*\.|!)", "")).alias("name"), kind.alias("kind"))
    return named.filter("name is not null and name <> ''").distinct()


def read_rule_table(spark: SparkSession, path: str) -> DataFrame:
    """The rules of text files, as a table."""
    return rule_table(spark.read.text(path))


def registrable_names(names: DataFrame, rules: DataFrame, host: str = "host") -> DataFrame:
    """(host, registrable) of each distinct host: the longest matching rule's suffix and one label more; the host of an address; NULL where
    no rule matches or the host is a suffix itself. A NULL host has no row."""
    distinct = names.select(F.col(f"`{host}`").alias("host")).filter("host is not null").distinct()
    address = F.col("host").rlike(H._IPV4) | F.contains("host", F.lit(":"))
    bare = F.regexp_replace(F.lower("host"), r"\.$", "")
    parents = distinct.select("host", address.alias("address"), H.host_suffixes(bare).alias("parents"))
    asked = parents.filter("not address").select("host", F.posexplode("parents").alias("i", "name"))
    # each table is written before it is measured, so that measuring it doesn't make it again
    met = asked.join(small(written(rules.select("name", "kind"), "rules")), "name")
    # the place of the suffix a rule makes of the host: 0 is the host, 1 its parent
    place = F.when(F.col("kind") == PLAIN, F.col("i")).when((F.col("kind") == WILD) & (F.col("i") > 0), F.col("i") - 1)
    ends = met.groupBy("host").agg(
        F.min(place).alias("suffix"), F.min(F.when(F.col("kind") == EXCEPTION, F.col("i"))).alias("taken_out"),
    )
    at = F.coalesce("taken_out", F.col("suffix") - 1)
    name = F.when(at >= 0, F.get("parents", at))
    found = parents.join(small(written(ends, "ends")), "host", "left")
    named = F.when(F.col("address"), F.col("host")).when(~F.startswith(name, F.lit(".")), name)
    return found.select("host", named.alias("registrable"))


def with_sites(rows: DataFrame, rules: DataFrame, host: str, *, registrable: str = "registrable", site: str = "site") -> DataFrame:
    """Add the registrable domain and the site (that, or the host in lower case) of each row's host."""
    names = written(registrable_names(rows, rules, host), "sites").withColumnsRenamed({"host": "_host", "registrable": "_registrable"})
    joined = rows.join(small(names), F.col(f"`{host}`") == F.col("_host"), "left")
    return joined.withColumns({registrable: F.col("_registrable"), site: F.coalesce("_registrable", F.lower(F.col(f"`{host}`")))}).drop("_host", "_registrable")
