"""Rules are made once, however often tables that come from them are measured."""

from pyspark.sql import functions as F

from urlsift.operators import sites as S


def test_rules_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(line):
        made.add(1)
        return line

    lines = spark.createDataFrame([("com",), ("test",)], "value string").select(seen.asNondeterministic()("value").alias("value"))
    hosts = spark.createDataFrame([("a.b.com",), ("x.test",), (None,), ("10.0.0.1",)], "host string")
    found = {r.host: r.registrable for r in S.with_sites(hosts, S.rule_table(lines), "host").collect()}
    assert found == {"a.b.com": "b.com", "x.test": "x.test", None: None, "10.0.0.1": "10.0.0.1"}
    assert made.value == 2
