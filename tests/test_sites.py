"""Sites by a rule table against the row-local expressions, and CSV values at the edge."""

from pyspark.sql import functions as F

from urlsift.functions import hosts as H
from urlsift.operators import sites as S
from urlsift.sources import files

RULES = ["com", "co.uk", "uk", "*.ck", "!www.ck", "*.kobe.jp", "!city.kobe.jp", "jp", "a.b.com", "xn--p1ai"]
HOSTS = [
    "example.com", "WWW.Example.COM.", "com", "a.co.uk", "co.uk", "www.ck", "x.www.ck", "y.z.ck", "z.ck", "ck", "q.city.kobe.jp", "c.d.kobe.jp", "kobe.jp",
    "q.a.b.com", "a.b.com", "b.com", "10.0.0.1", "::1", "localhost", ".com", "x..com", "", "пример.рф", "n.xn--p1ai", None,
]


def test_table_equals_expression(spark):
    rows = spark.createDataFrame(list(enumerate(HOSTS)), "i int, host string")
    rules = S.rule_table(spark.createDataFrame([(r,) for r in [*RULES, "// no rule", "", "  com  x", None]], "value string"))
    assert rules.count() == len(RULES)
    got = {r.i: (r.registrable, r.site) for r in S.with_sites(rows, rules, "host").collect()}
    want = rows.select("i", H.registrable_domain(F.col("host"), RULES).alias("r"), H.site_of_host(F.col("host"), RULES).alias("s")).collect()
    assert got == {r.i: (r.r, r.s) for r in want}


def test_names_in_other_scripts(spark):
    rules = S.rule_table(spark.createDataFrame([("*.рф",), ("!bücher.рф",)], "value string"))
    assert {(r.name, r.kind) for r in rules.collect()} == {("xn--p1ai", "wild"), ("xn--bcher-kva.xn--p1ai", "exception")}


def test_no_rules_and_no_hosts(spark):
    none = spark.createDataFrame([], "value string")
    rows = spark.createDataFrame([(1, "a.com")], "i int, host string")
    assert [(r.registrable, r.site) for r in S.with_sites(rows, S.rule_table(none), "host").collect()] == [(None, "a.com")]
    assert S.with_sites(rows.limit(0), S.rule_table(none), "host").collect() == []


def test_no_rule_is_a_literal(spark):
    many = spark.range(10_000).select(F.format_string("rule%d.example", "id").alias("value"))
    rows = spark.range(100).select(F.format_string("a.rule%d.example", "id").alias("host"))
    found = S.with_sites(rows, S.rule_table(many), "host")
    assert "rule77.example" not in found._jdf.queryExecution().toString()
    assert found.filter("site <> host").count() == 0 and found.filter("registrable is null").count() == 0


def test_csv_keeps_blanks_and_empty_values(spark, tmp_path):
    rows = [(1, "  x  "), (2, "\ttab\t"), (3, ""), (4, None), (5, ' "q" '), (6, " \n "), (7, ",")]
    files.write_csv(spark.createDataFrame(rows, "id long, t string"), str(tmp_path / "csv"))
    back = files.read_csv(spark, str(tmp_path / "csv"), "id long, t string").collect()
    assert sorted(tuple(r) for r in back) == rows
