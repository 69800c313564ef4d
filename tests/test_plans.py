"""Plan shape checks: pruning, pushdown, no single-partition step on data-sized operators."""

from arrivo.plans import pipeline as pl
from arrivo.sources import fixtures as fx


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_scans_only_needed_columns(spark, sf):
    p = plan(pl.fact(spark, sf))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in p or "l_orderkey:bigint,l_quantity:double" in p
    assert "SinglePartition" not in p


def test_quote_date_filter_reaches_the_scan(spark, sf):
    p = plan(pl.clean_quotes(spark, sf))
    assert "PushedFilters" in p and "o_orderdate" in p.split("PushedFilters")[1].split("]")[0]


def test_final_table_uses_broadcast_for_side_tables(spark, sf):
    df = pl.final(spark, sf)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in final
    # the only single-partition exchanges feed the two month-table median windows (quotes, interest),
    # tables of one row per month; nothing row-level goes through a single task
    body = final.split("== Initial Plan ==")[0]
    lines = body.splitlines()
    single = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert len(single) == 2
    for i in single:
        assert any("Window [percentile" in lines[j] for j in range(max(0, i - 4), i))


def test_fact_plan_without_broadcast_reuses_line_partitioning(spark, sf):
    """At scale (no broadcast of order-sized tables) the line aggregate's partitioning feeds the join directly."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        p = pl.fact(spark, sf)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert p.count("hashpartitioning(l_orderkey") == 1
    assert p.count("hashpartitioning(o_orderkey") == 1
    assert "partial_sum((cast(l_quantity" in p


def test_final_table_runs_the_arrival_join_once(spark, sf):
    df = pl.final(spark, sf)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # one line-table scan for the fact and one for the interest series; the month-count branch reuses
    assert p.count("lineitem.parquet") == 2 and "ReusedExchange" in p
