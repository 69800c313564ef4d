"""Driver contract: entry runs, every query is registered, and fast queries match their SQL twins."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E

FAST = ["quarter_to_month", "month_key", "calendar_flags", "clean_text", "coerce_numbers", "coerce_dates",
        "quote_filter", "map_categories", "category_report", "monthly_fact", "quotes_monthly", "interest_monthly",
        "final_table", "totals_by_point", "top_pairs", "season_peak", "box_stats", "describe", "null_report",
        "duplicates", "iqr_outliers", "page_links", "page_links_fallback", "newest_link", "lags", "pivot_points",
        "month_gaps", "ordered_split", "fold_ids", "scenario_grid", "sample_rows", "zero_removal"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "turistas" in df.columns


def test_registry_is_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 85


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: tuple(map(str, t)))
    return [cols[i] for i in order], out


@pytest.mark.parametrize("name", FAST)
def test_matches_sql_twin(spark, sf, name):
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
              "labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    sdf = E.queries()[name](spark, sf)
    cur = con.execute(E.oracle_sql()[name])
    assert _canon(sdf.columns, [tuple(r) for r in sdf.collect()]) == _canon([d[0] for d in cur.description], cur.fetchall())
