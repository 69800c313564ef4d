"""Counters observed on the write of the standardised rows."""

from arrivo.operators.clean import standardise_arrivals
from arrivo.operators.counters import RunCounters
from arrivo.sources import catalog

RAW = [("q", "2001-01-01", "francia", "10"), ("q", "2001-04-01", "francia", "n/a"), ("m", "nothing", "chile", "5"),
       ("m", "1990-01-01", "chile", "7"), ("m", "2001-02-01", "chile", None), ("m", "2001-03-01", "chile", "8"), ("x", "2001-01-01", "peru", "1")]


def run(spark, rows, path):
    raw = spark.createDataFrame(rows, "src string, period string, country string, visitors string").repartition(3)
    cat = catalog.catalog(spark, [catalog.SourceSpec(src="q", path="q"), catalog.SourceSpec(src="m", path="m", frequency="mensual")])
    watch = RunCounters()
    watched = standardise_arrivals(raw, cat, "1995-01-01", watch)
    watched.write.parquet(path)
    plain = standardise_arrivals(raw, cat, "1995-01-01")
    assert sorted(spark.read.parquet(path).collect()) == sorted(plain.collect())
    return watch


def test_counters_of_a_run(spark, tmp_path):
    watch = run(spark, RAW, str(tmp_path / "t"))
    want = {"rows_read": 7, "rows_of_known_sources": 6, "unknown_sources": 1, "bad_numbers": 2, "bad_dates": 1, "before_floor": 1,
            "total_kept": 18, "rows_out": 8, "total_out": 17, "split_loss": 1}
    assert watch.values() == want
    assert watch.table(spark).first().asDict() == want


def test_counters_of_an_empty_run(spark, tmp_path):
    assert set(run(spark, [], str(tmp_path / "t")).values().values()) == {0}
