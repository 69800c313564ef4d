"""Profiles, feature stages and models against hand computations."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from arrivo.operators import features as FE
from arrivo.operators import model as MO
from arrivo.operators import clean, profile, reports


def test_describe_matches_pandas(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    r = profile.describe(df, ["x"]).first()
    assert (r["q50"], r["q25"]) == (2.5, 1.75)
    assert abs(r["std"] - 4.08248290463863) <= 5e-7  # describe rounds to 6 places
    assert r["mean"] == 4.0 and r["count"] == 4


def test_correlations_pairwise_like_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.normal(size=(60, 3)), columns=["a", "b", "c"])
    pdf.loc[::7, "b"] = np.nan
    pdf["k"] = 3.0  # constant: dropped
    df = spark.createDataFrame(pdf)
    got = {(r["columna_a"], r["columna_b"]): r["correlacion"] for r in profile.correlations(df, drop=()).collect()}
    want = pdf[["a", "b", "c"]].corr()
    assert set(got) == {("a", "b"), ("a", "c"), ("b", "c")}
    for (a, b), v in got.items():
        assert abs(v - want.loc[a, b]) < 1e-6


def test_constant_columns_have_no_correlation_with_the_target(spark):
    n = 400
    pdf = pd.DataFrame({"turistas": np.arange(1, n + 1), "up": np.arange(n) * 2.0 + (np.arange(n) % 7), "flat": 4.9, "none": np.nan})
    pdf["holes"] = np.where(np.arange(n) % 3 == 0, np.nan, -(np.arange(n) % 50.0))
    pdf["once"] = np.where(np.arange(n) == 5, 1.0, np.nan)  # one value
    df = spark.createDataFrame(pdf).replace(float("nan"), None).repartition(7)
    got = {r["columna"]: r["correlacion"] for r in profile.target_correlations(df).collect()}
    want = pdf.corr()["turistas"]
    assert got == {c: pytest.approx(want[c], abs=1e-6) for c in ("up", "holes")}
    assert profile.target_correlations(df.withColumn("turistas", F.lit(3))).count() == 0
    assert profile.target_correlations(df.limit(0)).count() == 0


def test_scatter_of_a_group_with_one_price(spark):
    rows = [("a", 4.9, k) for k in range(30)] + [("b", float(k), 2 * k) for k in range(30)] + [("c", 1.0, 1)]
    df = spark.createDataFrame(rows, "g string, x double, y long").repartition(5)
    got = {r["g"]: (r["n"], r["corr"]) for r in clean.scatter_pairs(df, "x", "y", "g").collect()}
    assert got == {"a": (30, None), "b": (30, pytest.approx(1.0)), "c": (1, None)}


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), ("d", 1)], "k string, turistas long")
    assert [r["k"] for r in reports.top_k(df, ["k"], 3).collect()] == ["c", "a", "b"]


def test_season_peak_tie_takes_earliest_month(spark):
    df = spark.createDataFrame([("x", 2, 10), ("x", 3, 10), ("x", 4, 5)], "pais_origen string, mes int, turistas long")
    r = reports.season_peak(df).first()
    assert (r["mes_pico"], r["mes_bajo"], r["variacion_pct"]) == (2, 4, 100.0)


def test_median_imputer_is_exact_and_interpolated(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    m = FE.MedianImputer(inputCols=["x"]).fit(df)
    assert m.getOrDefault(m.values) == [2.5]
    assert sorted(r["x"] for r in m.transform(df).collect()) == [1.0, 2.0, 2.5, 3.0, 10.0]


def test_population_scaler(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (4.0, 7.0)], "x double, c double")
    out = FE.PopulationScaler(inputCols=["x", "c"]).fit(df).transform(df).orderBy("x").collect()
    want = [-1.06904497, -0.26726124, 1.33630621]
    assert all(abs(r["x"] - w) < 1e-8 for r, w in zip(out, want))
    assert all(r["c"] == 0.0 for r in out)


def test_unknown_category_encodes_as_zeros(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "cat string, x double")
    pre = FE.preprocessing_pipeline(["x"], ["cat"]).fit(train)
    score = spark.createDataFrame([("z", 1.0), (None, 1.0), ("b", 1.0)], "cat string, x double")
    vecs = [list(r["features"].toArray()) for r in pre.transform(score).collect()]
    assert vecs[0][1:] == [0.0, 0.0] and vecs[1][1:] == [0.0, 0.0] and vecs[2][1:] == [0.0, 1.0]


def test_ordered_split_and_folds(spark):
    df = spark.range(2488).select(F.format_string("%05d", "id").alias("indice_tiempo"),
                                  F.lit("o").alias("pais_origen"), F.lit("p").alias("punto_entrada"),
                                  F.col("id").alias("turistas"))
    s = FE.with_split(df)
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts == {"train": 1990, "test": 498}
    folds = sorted(r["count"] for r in s.filter("split = 'train'").groupBy("fold").count().collect())
    assert folds == [398, 398, 398, 398, 398]
    last_train = s.filter("split = 'train'").agg(F.max("pos")).first()[0]
    first_test = s.filter("split = 'test'").agg(F.min("pos")).first()[0]
    assert last_train < first_test


def test_ridge_matches_closed_form(spark):
    rng = np.random.default_rng(0)
    n, k = 120, 3
    x = rng.normal(size=(n, k))
    y = x @ np.array([2.0, -1.0, 0.5]) + 3 + rng.normal(size=n)
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(turistas=y)
    df = spark.createDataFrame(pdf)
    from pyspark.ml.feature import VectorAssembler

    v = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    m = MO.regressor("ridge", {"alpha": 5.0}, v).fit(v)
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + 5.0 * np.eye(k), xc.T @ yc)
    assert np.abs(np.array(m.coefficients) - w).max() < 1e-8


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([("t", 1.0, 2.0), ("t", 3.0, 3.0), ("t", 5.0, 4.0)],
                               "split string, turistas double, prediction double")
    r = MO.metrics(df).first()
    assert math.isclose(r["rmse"], math.sqrt(2 / 3)) and math.isclose(r["mae"], 2 / 3)
    assert math.isclose(r["r2"], 1 - 2 / 8)


def test_draws_are_distinct_and_seeded():
    a, b = MO.draw_params("ridge", 30, 42), MO.draw_params("ridge", 30, 42)
    assert a == b and len({tuple(sorted(p.items())) for p in a}) == 30


def test_duplicates_exact_with_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1), ("b", None), ("b", None), ("c", 2)], "t string, x int")
    r = profile.duplicates(df).first()
    assert (r["filas"], r["duplicados"], r["pct"]) == (6, 3, 50.0)


def test_role_resolver_rules():
    from arrivo.operators.clean import ARRIVAL_ROLES, Role, resolve_role, resolve_roles

    cols = ["Periodo", "turistas_total", "turistas_no_residentes", "pais_residencia"]
    found, missing = resolve_roles(cols, ARRIVAL_ROLES)
    assert found == {"period": "Periodo", "visitors": "turistas_no_residentes", "country": "pais_residencia"}
    assert missing == []
    assert resolve_role(["fecha", "fecha_std"], Role("d", exact=("fecha", "fecha_std"), policy="last")) == "fecha_std"
    assert resolve_roles(["a", "b"], ARRIVAL_ROLES)[1] == ["period", "visitors", "country"]
