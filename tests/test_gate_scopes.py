"""Both reference scopes of the gate come from one reading of the pages."""

from pyspark.sql import functions as F

from catalog.fixtures import pages_rich
from urlsift.operators import page_features as PF
from urlsift.plans import agreement_report as AR


def test_pages_are_read_once_for_both_scopes(spark, sf, monkeypatch):
    pages = pages_rich(spark, sf).filter("page_id < 40").withColumn("sha1", F.sha1(F.encode("html", "UTF-8")))
    singles = [PF.page_features(pages, keys=("sha1",), scope=s) for s in ("anchor", "all_resources")]
    want = singles[0].join(singles[1].select("sha1", *[F.col(c).alias(f"{c}_all_resources") for c in AR.REFERENCES]), "sha1")
    found = PF.page_features(pages, keys=("sha1",), also=("all_resources",))
    assert found.columns == want.columns and sorted(map(str, found.collect())) == sorted(map(str, want.collect()))

    reads, scan = [], PF.scan_pages
    monkeypatch.setattr(PF, "scan_pages", lambda *args: reads.append(1) or scan(*args))
    expected = singles[1].drop("Title").join(pages.select("sha1", F.col("url").alias("final_url")), "sha1").withColumn("label", F.lit(1))
    _, scopes = AR.gate_both(expected, pages.select("sha1", "html"))
    assert {r["scope"]: r["chosen"] for r in scopes.collect()} == {"anchor": False, "all_resources": True} and len(reads) == 1
