"""Values, texts, dates and files that a first version lost: no cuts, no caps, tables as part files."""

import datetime as dt
import os
import shutil

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from arrivo.functions import clean_text, number_or_zero, parse_ts, strip_ws
from arrivo.operators import assemble, profile, quality
from arrivo.sources import catalog
from arrivo.streaming import land_new_files

VALIDATION = ["file_checks", "category_rollup", "issues", "readiness", "run_report", "json_report_roundtrip",
              "landing_manifest", "incremental_landing", "run_metrics", "duplicates", "top_correlations"]
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def column(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


@pytest.mark.parametrize("values", [[0.001, 0.002, 0.004], [1e-9, 2e-9], [3e17, 3.5e17, 4e17], [1.0, None, 2.5], [5.0]])
def test_describe_takes_values_as_they_are(spark, values):
    r = profile.describe(column(spark, values)).first()
    mean, std = duckdb.sql(f"SELECT avg(v), stddev_samp(v) FROM (VALUES {', '.join('(NULL)' if v is None else f'({v!r}::DOUBLE)' for v in values)}) t(v)").fetchall()[0]
    assert r["mean"] == pytest.approx(mean, rel=1e-9, abs=5e-7)
    assert (r["std"] is None) == (std is None) and (std is None or r["std"] == pytest.approx(std, rel=1e-9, abs=5e-7))


def test_target_profile_of_small_values(spark):
    r = profile.target_profile(column(spark, [0.001, 0.002, 0.004]), "v").first()
    assert r["media"] == pytest.approx(0.0023333333) and r["cv_pct"] == pytest.approx(65.47, abs=0.05)


def test_numbers_beyond_a_long_are_zero(spark):
    got = column(spark, ["1e30", "-1e30", " 12.9 ", "x", None], "string").select(number_or_zero("v")).collect()
    assert [r[0] for r in got] == [0, 0, 12, 0, 0]


def test_strip_takes_every_unicode_blank(spark):
    values = ["\u00a0a b\u00a0", "\u2003x\u3000", "\x1cq\x1f", "\t y\n", "\u200bz"]
    got = column(spark, values, "string").select(strip_ws("v"), clean_text("v")).collect()
    assert [r[0] for r in got] == [v.strip() for v in values] and [r[1] for r in got] == [v.strip().title() for v in values]


def test_date_forms(spark):
    cases = {"15/03/2014": dt.datetime(2014, 3, 15), "03/15/2014": dt.datetime(2014, 3, 15), "20140315": dt.datetime(2014, 3, 15),
             "03/04/2014": dt.datetime(2014, 3, 4), "2014/3/5": dt.datetime(2014, 3, 5), "5-3-2014 10:30:00": dt.datetime(2014, 5, 3, 10, 30),
             "2014-03-15": dt.datetime(2014, 3, 15), "99/99/2014": None, "hello": None, "": None, None: None}
    df = column(spark, list(cases), "string")
    assert [r[0] for r in df.select(parse_ts("v")).collect()] == list(cases.values())
    assert df.where("v = '03/04/2014'").select(parse_ts("v", day_first=True)).first()[0] == dt.datetime(2014, 4, 3)


def test_rank_keeps_rows_without_a_month(spark):
    df = spark.createDataFrame([("2014-01", "a", "p"), (None, "b", "p"), ("2014-02", "c", "p")],
                               "indice_tiempo string, pais_origen string, punto_entrada string")
    assert {(r.pais_origen, r.pos) for r in assemble.positional_rank(df).collect()} == {("b", 1), ("a", 2), ("c", 3)}


def test_row_minimum_uses_all_rows(spark, tmp_path):
    spark.range(250).selectExpr("id AS a", "id AS b", "id AS c").repartition(4).write.parquet(str(tmp_path / "t.parquet"))
    files = catalog.file_sizes(spark, str(tmp_path))
    checks = quality.file_checks(files, {"t": spark.read.parquet(str(tmp_path / "t.parquet"))}, {"t": "economico"}, min_rows=200)
    r = checks.first()
    assert (r.rows, r.files, r.has_data, r.data_quality) == (250, 4, True, "good")
    assert r.size == sum(f.stat().st_size for f in (tmp_path / "t.parquet").glob("*.parquet"))
    small = quality.file_checks(files, {"t": spark.read.parquet(str(tmp_path / "t.parquet")).limit(0)}, {}, min_bytes=1 << 30).first()
    assert small.status == "error" and small.category == "general"


def test_only_a_missing_path_leads_to_the_sample(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "sample"))
    assert catalog.read_first(spark, [str(tmp_path / "full"), str(tmp_path / "sample")]).count() == 3
    def refuse(path):
        raise PermissionError(path)
    with pytest.raises(PermissionError):
        catalog.read_first(spark, [str(tmp_path / "sample")], reader=refuse)
    with pytest.raises(FileNotFoundError):
        catalog.read_first(spark, [str(tmp_path / "none")])


def test_landing_counts_all_batches(spark, tmp_path):
    src = tmp_path / "src"
    spark.range(120).repartition(120).write.parquet(str(src))
    n = land_new_files(spark, str(src), "id bigint", str(tmp_path / "sink"), str(tmp_path / "ck"), "r1", max_files_per_trigger=1)
    assert n == 120
    assert land_new_files(spark, str(src), "id bigint", str(tmp_path / "sink"), str(tmp_path / "ck"), "r2") == 0


def test_duplicates_move_no_text(spark, sf):
    plan = E.queries()["duplicates"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "sha2" not in line
    scans = [line for line in plan.splitlines() if "documents.parquet" in line and "Scan" in line]
    assert len(scans) == 1


@pytest.fixture(scope="module")
def part_files(spark, sf, tmp_path_factory):
    """Folders of part files. Tables under the least size are one part of the same size, so that all keep their side of it."""
    root = tmp_path_factory.mktemp("parts")
    for t in TABLES:
        if os.path.getsize(f"{sf}/{t}.parquet") < catalog.DEFAULTS["min_bytes"]:
            (root / f"{t}.parquet").mkdir()
            shutil.copy(f"{sf}/{t}.parquet", root / f"{t}.parquet" / "part-0.parquet")
            continue
        spark.read.parquet(f"{sf}/{t}.parquet").repartition(3).write.parquet(str(root / f"{t}.parquet"))
    return str(root)


def rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", VALIDATION)
def test_tables_as_part_files_give_the_same(spark, sf, part_files, name):
    assert os.path.isdir(f"{part_files}/region.parquet")
    got, want = (E.queries()[name](spark, d) for d in (part_files, sf))
    assert rows(got) == rows(want) and got.count() > 0


def test_changed_input_under_one_path_is_read_anew(spark, tmp_path, sf):
    from arrivo.plans import pipeline as pl

    path = str(tmp_path / "t.parquet")
    spark.range(3).write.parquet(path)
    build = lambda: spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))
    assert pl.written_once(spark, str(tmp_path), "n", build).first()[0] == 3
    spark.range(5).write.mode("append").parquet(path)
    assert pl.written_once(spark, str(tmp_path), "n", build).first()[0] == 8


def test_links_of_any_quoting_and_entities(spark):
    from arrivo.sources import pages

    html = ("<a href=\"/one.csv\">One</a> <A class=x HREF='/dos.csv'>A&ntilde;o &oacute; &#243; &#xF1; &#8364;</A><a href=/tres.csv>3"
            "<p>text</p><a data-href='/no' name=n>none</a><a href=\"/q?a=1&amp;b=2\"><b>&lt;4&gt;</b>\u00a0</a><a href='/last.csv'>open")
    rows = pages.links(spark.createDataFrame([(1, "https://h.org/d/p", html)], "page_id int, url string, html string")).orderBy("pos").collect()
    assert [(r.href, r.text) for r in rows] == [("/one.csv", "One"), ("/dos.csv", "A\u00f1o \u00f3 \u00f3 \u00f1 \u20ac"),
                                                ("/tres.csv", "3text"), ("/q?a=1&b=2", "<4>"), ("/last.csv", "open")]
    found = pages.target_links(spark.createDataFrame([(1, "https://h.org/d/p", html)], "page_id int, url string, html string"), ["a\u00f1o", "last"])
    assert {(r.target, r.link) for r in found.collect()} == {("a\u00f1o", "https://h.org/dos.csv"), ("last", "https://h.org/last.csv")}


def test_drawn_maps_differ_in_what_spark_gets(spark):
    from arrivo.operators import model as MO

    for kind, n in MO.SEARCH_DRAWS.items():
        maps = MO.draw_params(kind)
        assert len({MO.effective(kind, p) for p in maps}) == len(maps) == n
    with pytest.raises(ValueError):
        MO.regressor("forest", {"max_depth": 31})
