"""The size rule (S5, S6) at the reference's limit, against sizes, rows and columns read without Spark."""

import os

import pyarrow.parquet as pq
import pytest

import __spark_entry__ as E
from arrivo.operators import quality
from arrivo.plans.queries_sources import CATEGORY_OF
from arrivo.sources import catalog
from arrivo.sources import fixtures as fx


def plain_status(root, name):
    path = f"{root}/{name}.parquet"
    meta = pq.read_metadata(path)
    if os.path.getsize(path) >= 2000:
        return "cached"
    return "downloaded_small" if meta.num_rows > 0 and meta.num_columns > 2 else "error"


@pytest.fixture(scope="module")
def want(sf):
    return {n: plain_status(sf, n) for n in fx.TABLES}


def test_sized_checks_against_plain_rule(spark, sf, want):
    got = {r["name"]: (r["status"], r["size"]) for r in E.queries()["sized_checks"](spark, sf).collect()}
    assert got == {n: (s, os.path.getsize(f"{sf}/{n}.parquet")) for n, s in want.items()}
    assert set(want.values()) == {"cached", "downloaded_small", "error"}


def test_sized_report_and_rollup_count_rejected_tables(spark, sf, want):
    failed = sum(s == "error" for s in want.values())
    r = E.queries()["sized_report"](spark, sf).first()
    assert (r.total_files, r.successful_files, r.failed_files) == (len(want), len(want) - failed, failed)
    assert r.success_rate == round((len(want) - failed) * 100 / len(want), 1) < 100
    skipped = {r.category: (r.processed, r.skipped) for r in E.queries()["sized_rollup"](spark, sf).collect()}
    for c, counts in skipped.items():
        own = [s for n, s in want.items() if CATEGORY_OF.get(n, "general") == c]
        assert counts == (sum(s != "error" for s in own), sum(s == "error" for s in own))


def test_sized_manifest_knows_small_and_missing_tables(spark, sf, want):
    got = {r.src: (r.status, r.min_bytes, r.admitted) for r in E.queries()["sized_manifest"](spark, sf).collect()}
    assert got == {n: (s, 2000, s != "error") for n, s in want.items()} | {"missing_feed": ("error", 2000, False)}
    plain = {r.src: (r.status, r.min_bytes, r.admitted) for r in E.queries()["landing_manifest"](spark, sf).collect()}
    assert plain == got


def test_size_of_part_files_is_their_sum(spark, tmp_path):
    tables = {}
    for name, cols, rows in (("two", 2, 5), ("three", 3, 5), ("none", 3, 0), ("parts", 2, 40)):
        path = str(tmp_path / f"{name}.parquet")
        df = spark.range(rows).selectExpr(*[f"id AS c{k}" for k in range(cols)])
        df.repartition(4 if name == "parts" else 1).write.parquet(path)
        tables[name] = spark.read.parquet(path)
    sizes = {r["name"]: r["size"] for r in catalog.file_sizes(spark, str(tmp_path)).collect()}
    limit = max(sizes[n] for n in ("two", "three", "none")) + 1
    assert max(p.stat().st_size for p in (tmp_path / "parts.parquet").glob("*.parquet")) < limit <= sizes["parts"]
    checks = quality.file_checks(catalog.file_sizes(spark, str(tmp_path)), tables, {}, min_bytes=limit).collect()
    assert {r["name"]: r.status for r in checks} == {"two": "error", "three": "downloaded_small", "none": "error", "parts": "cached"}
    assert {r["name"]: r.header_status for r in checks}["three"] == "downloaded_small"
