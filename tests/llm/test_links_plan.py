"""The links of fingerprints never broadcast the exploded probes, whatever Spark takes their size for."""

from pyspark.sql import functions as F

from urlsift.llm import simhash


def test_probes_are_not_broadcast(spark, tmp_path):
    path = str(tmp_path / "fp")
    spark.range(500).select(F.xxhash64("id").alias("fp")).write.parquet(path)
    plan = simhash.links(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in plan and "SortMergeJoin" in plan and "Broadcast" not in plan
