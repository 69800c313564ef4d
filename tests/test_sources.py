"""Link discovery, landing validation rules and the incremental file stream."""

import tempfile

from pyspark.sql import functions as F

from arrivo.operators import quality
from arrivo.sources import pages


def test_resolve_relative_links(spark):
    df = spark.createDataFrame([("https://h.example/en/25#top", "/a.csv"), ("https://h.example/en/25", "b.csv"),
                                ("http://x.org/p?q=1", "//cdn.org/c.csv"), ("https://h.example/", "http://o.org/d.csv")],
                               "url string, href string")
    got = [r["r"] for r in df.select(pages.resolve(F.col("href"), F.col("url")).alias("r")).collect()]
    assert got == ["https://h.example/a.csv", "https://h.example/en/b.csv", "http://cdn.org/c.csv", "http://o.org/d.csv"]


def test_later_match_wins_and_fallback_is_anti_join(spark):
    html1 = '<a href="/x/alpha_1.csv">one</a> <a href="/y/alpha_2.csv">two</a> <a href="rel/alpha_3.csv">three</a>'
    html2 = '<a href="/z/Beta-Gamma.csv">Beta <b>Gamma</b></a>'
    p = spark.createDataFrame([(1, "https://s.example/a/b", html1), (2, "https://s.example/", html2)],
                              "page_id long, url string, html string")
    s8 = pages.target_links(p, ["alpha"], ".csv").collect()
    assert [(r["page_id"], r["link"]) for r in s8] == [(1, "https://s.example/y/alpha_2.csv")]
    s9 = pages.keyword_links(p, [["beta", "gamma"]], ".csv", exclude=pages.target_links(p, ["alpha"], ".csv")).collect()
    assert [(r["page_id"], r["set_no"], r["link"]) for r in s9] == [(2, 1, "https://s.example/z/Beta-Gamma.csv")]


def test_small_file_rule_and_shared_admission(spark):
    df = spark.createDataFrame([("cached",), ("downloaded_small",), ("error",), ("downloaded",)], "status string")
    assert [r[0] for r in df.select(quality.ok_status()).collect()] == [True, True, False, True]


def test_incremental_landing_skips_landed_files(spark, sf):
    from arrivo.streaming import land_new_files

    root = tempfile.mkdtemp(prefix="arrivo-land-")
    schema = spark.read.parquet(f"{sf}/orders.parquet").schema
    n1 = land_new_files(spark, sf, schema, f"{root}/sink", f"{root}/ck", "r1", file_glob="orders.parquet")
    n2 = land_new_files(spark, sf, schema, f"{root}/sink", f"{root}/ck", "r2", file_glob="orders.parquet")
    assert n1 == spark.read.parquet(f"{sf}/orders.parquet").count() and n2 == 0


def test_monthly_batch_run_writes_outputs(spark, sf):
    from arrivo.__main__ import run

    out = tempfile.mkdtemp(prefix="arrivo-run-")
    res = run(spark, sf, out, "2001-12-31")
    assert res["final_rows"] > 0
    rep = spark.read.json(f"{res['out']}/reports/run_report").first()
    assert rep["status"] == "completed" and rep["acquisition"]["total_files"] == 14
    cur = spark.read.parquet(f"{res['out']}/curated")
    assert set(cur.select("source").distinct().toPandas()["source"]) == {"1-URGENT", "2-HIGH", "3-MEDIUM",
                                                                           "4-NOT SPECIFIED", "5-LOW"}
