"""Landing with kept status: two runs over a growing folder, a batch that fails, quarantine."""

import pytest
from pyspark.sql import functions as F

from arrivo.sources import catalog
from arrivo.streaming import status

LARGE = "a,b\n" + "1,2\n" * 1000
SMALL = 'a,b,c\n1,"x\ny",3\n4,5,6\n'
BAD = "a,b\n1,2\n"


def sources(spark):
    return catalog.catalog(spark, [catalog.SourceSpec(src=n, path=n) for n in ("large", "small", "bad", "late", "parts", "missing")])


def by_source(df):
    return {r.src: (r.status, r.size, r.admitted) for r in df.collect()}


@pytest.fixture
def folder(tmp_path):
    root = tmp_path / "in"
    root.mkdir()
    for name, text in (("large", LARGE), ("small", SMALL), ("bad", BAD)):
        (root / f"{name}.csv").write_text(text)
    return root


def test_two_runs_over_a_growing_folder(spark, folder, tmp_path):
    home, cat = str(tmp_path / "home"), sources(spark)
    first = by_source(status.land_with_status(spark, str(folder), home, cat, "2001-01", "csv"))
    none = ("error", 0, False)
    assert first == {"large": ("downloaded", len(LARGE), True), "small": ("downloaded", len(SMALL), True),
                     "bad": none, "late": none, "parts": none, "missing": none}
    (folder / "late.csv").write_text(LARGE)
    (folder / "parts.csv").mkdir()
    for k in range(3):  # each part is too small, together they are a table
        (folder / "parts.csv" / f"part-{k}.csv").write_text("a,b\n" + "1,2\n" * 300)
    second = by_source(status.land_with_status(spark, str(folder), home, cat, "2001-02", "csv", max_files=2))
    assert second == {"large": ("cached", len(LARGE), True), "small": ("downloaded", len(SMALL), True), "bad": none,
                      "late": ("downloaded", len(LARGE), True), "parts": ("downloaded", 3 * 1204, True), "missing": none}
    third = by_source(status.land_with_status(spark, str(folder), home, cat, "2001-03", "csv"))
    assert {k: v[0] for k, v in third.items()} == {"large": "cached", "small": "downloaded", "bad": "error", "late": "cached",
                                                   "parts": "cached", "missing": "error"}
    kept = spark.read.parquet(f"{home}/quarantine/run=2001-02").collect()
    assert [(r["name"], bytes(r.content).decode()) for r in kept] == [("bad", BAD)]
    small = {r.src: r.records for r in status.statuses(spark, home, cat, "2001-03").collect()}
    assert (small["small"], small["bad"], small["large"]) == (2, 1, None)


def test_failed_batch_is_taken_again(spark, folder, tmp_path, monkeypatch):
    home, cat, write = str(tmp_path / "home"), sources(spark), status._write_facts

    def fails(*args):
        write(*args)
        raise RuntimeError("lost after the write")

    monkeypatch.setattr(status, "_write_facts", fails)
    with pytest.raises(Exception, match="lost after the write"):
        status.land_with_status(spark, str(folder), home, cat, "2001-01", "csv")
    monkeypatch.setattr(status, "_write_facts", write)
    again = by_source(status.land_with_status(spark, str(folder), home, cat, "2001-01", "csv"))
    assert again["large"] == ("downloaded", len(LARGE), True)  # not counted twice, not taken for an earlier run's
    assert status.file_facts(spark, home).count() == 3


def test_broken_file_then_a_valid_part_and_an_empty_folder(spark, tmp_path):
    home, cat, root = str(tmp_path / "home"), sources(spark), tmp_path / "in"
    (root / "small.parquet").mkdir(parents=True)
    assert {r.status for r in status.land_with_status(spark, str(root), home, cat, "2001-01").collect()} == {"error"}
    (root / "small.parquet" / "a.parquet").write_bytes(b"PAR1 broken")
    assert by_source(status.land_with_status(spark, str(root), home, cat, "2001-02"))["small"] == ("error", 0, False)
    df = spark.range(3).select("id", F.lit(1).alias("b"), F.lit(2).alias("c")).toPandas()
    df.to_parquet(root / "small.parquet" / "b.parquet")
    cat = cat.withColumn("min_bytes", F.lit(100_000).cast("long"))
    got = {r.src: (r.status, r.records) for r in status.land_with_status(spark, str(root), home, cat, "2001-03").collect()}
    assert got["small"] == ("downloaded", 3)
