"""Exact order statistics by rank selection."""

import math
import random

import pytest
from pyspark.sql import functions as F

from arrivo.operators import profile, ranks, reports

PS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.fixture(scope="module")
def values(spark):
    """Groups with many distinct values, one hot value, few values, ties, nulls, infinities and a null key."""
    rng = random.Random(8)
    rows = [("many", rng.gauss(0, 1e6)) for _ in range(9000)]
    rows += [("hot", 7.0 if rng.random() < 0.6 else rng.random() * 14) for _ in range(6000)]
    rows += [("one", 3.5)] * 4000 + [("small", float(k)) for k in range(4)] + [("none", None)] * 5 + [("many", None)] * 50
    rows += [("wild", x) for x in [math.inf, -math.inf, 0.0, -0.0, 1e300, -1e300, 5e-324] * 300]
    rows += [(None, float(k % 10)) for k in range(3001)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "g string, x double").repartition(5)


@pytest.mark.parametrize("limit", [10, 300, ranks.LIMIT])
def test_quantiles_equal_percentile(values, limit):
    want = values.where("x IS NOT NULL").groupBy("g").agg(F.count("x").alias("n"), F.percentile("x", F.array(*[F.lit(p) for p in PS])).alias("q"))
    shown = lambda df: {r.g: (r.n, [repr(x + 0.0) for x in r.q]) for r in df.collect()}  # noqa: E731  NaN by name, one zero
    assert shown(ranks.quantiles(values, ["g"], "x", PS, limit=limit)) == shown(want)


def test_whole_table_two_keys_and_empty(values):
    two = values.withColumn("k", F.when(F.col("x") > 0, 1))
    for limit in (50, ranks.LIMIT):
        whole = ranks.quantiles(values.where("g = 'many'"), [], "x", [0.5], limit).first()
        assert whole.n == 9000 and whole.q == values.where("g = 'many'").agg(F.percentile("x", F.array(F.lit(0.5)))).first()[0]
        got = {(r.g, r.k): r.q for r in ranks.quantiles(two, ["g", "k"], "x", [0.3], limit).collect()}
        assert got == {(r.g, r.k): r.q for r in two.where("x IS NOT NULL").groupBy("g", "k").agg(F.percentile("x", F.array(F.lit(0.3))).alias("q")).collect()}
    assert ranks.quantiles(values.where("false"), ["g"], "x", [0.5]).collect() == []
    assert ranks.quantiles(values.where("x IS NULL"), [], "x", [0.5]).collect() == []


def test_no_percentile_buffer_in_the_plans(values, monkeypatch):
    """Neither path keeps a group's values in an aggregation buffer, and the operators use it."""
    rows = values.withColumn("flag", F.lit(1)).na.fill("", ["g"])
    for limit in (50, ranks.LIMIT):
        monkeypatch.setattr(ranks.quantiles, "__defaults__", (limit,))
        for df in (profile.describe(rows, ["x"]), profile.iqr_bounds(rows, "x"), reports.box_stats(rows, ["flag"], "x"), profile.target_profile(rows, "x")):
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            assert "percentile(" not in plan
            assert df.count() >= 1
    q = rows.agg(F.percentile("x", F.lit(0.25)), F.percentile("x", F.lit(0.75))).first()
    assert tuple(profile.iqr_bounds(rows, "x").first())[:2] == tuple(q)
