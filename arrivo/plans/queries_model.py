"""Driver queries for the split, features, models and their evaluation (M1-M18, W5, Q-19, Q-20, Q-22, S20)."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from arrivo.functions import rint_round
from arrivo.operators import features as FE
from arrivo.operators import model as MO
from arrivo.plans import oracle as O
from arrivo.plans import pipeline as pl
from arrivo.plans.queries import query
from arrivo.sources import fixtures as fx
from arrivo.sources.catalog import input_state
from arrivo.plans.queries_reports import FINAL_NUMERIC
from arrivo.session import memo, scratch_path

KEYS = ["indice_tiempo", "pais_origen", "punto_entrada"]
NUMERIC = [c for c in FINAL_NUMERIC if c != "turistas"]
CATEGORICAL = ["pais_origen", "punto_entrada"]


def model_table(spark, d):
    """Curated rows without zeros (C21), ranked, split and folded; written once to the shared folder.

    Every fit and metric reads this table several times; the write cuts the
    lineage back to the raw tables, so a lost executor recomputes from it.
    """
    from arrivo.operators.clean import drop_all_null_columns, drop_zero_target

    # C20 (columns null in every row are dropped), C21 (zero-target rows removed), then W5/M1/M9
    return pl.written_once(spark, d, "model_table",
                           lambda: FE.with_split(drop_zero_target(drop_all_null_columns(pl.curated(spark, d)))))


def feature_lists(df):
    num, cat = FE.feature_columns(df)
    return num, cat


_SPLIT_CTE = """
ms AS (
  SELECT *, row_number() OVER (ORDER BY indice_tiempo, pais_origen, punto_entrada) AS pos,
         CAST(floor(count(*) OVER () * 0.8) AS BIGINT) AS n_train
  FROM final WHERE turistas > 0),
ms2 AS (
  SELECT *, CASE WHEN pos <= n_train THEN 'train' ELSE 'test' END AS split,
         n_train // 5 AS q, n_train % 5 AS rem FROM ms)"""


@query("ordered_split", O.with_extra(["final"], _SPLIT_CTE, """
SELECT indice_tiempo, pais_origen, punto_entrada, pos, split FROM ms2"""))
def q_ordered_split(spark, d):
    """M1 + W5: global position in (month, origin, entry) order; the first int(0.8 n) rows are train."""
    return model_table(spark, d).select(*KEYS, "pos", "split")


@query("fold_ids", O.with_extra(["final"], _SPLIT_CTE, """
SELECT indice_tiempo, pais_origen, punto_entrada, pos,
       CAST(CASE WHEN pos - 1 < rem * (q + 1) THEN (pos - 1) // (q + 1)
                 ELSE rem + (pos - 1 - rem * (q + 1)) // q END AS INTEGER) AS fold
FROM ms2 WHERE split = 'train'"""))
def q_fold_ids(spark, d):
    """M9: contiguous, unshuffled 5-fold ids over the train rows (first n % 5 folds one row larger)."""
    return model_table(spark, d).filter(F.col("split") == "train").select(*KEYS, "pos", "fold")


@query("split_drift", O.with_extra(["final"], _SPLIT_CTE, f"""
SELECT n_train, n_test, {O.rnd("media_train", 4)} AS media_train, {O.rnd("media_test", 4)} AS media_test, dif AS diferencia_pct,
       CASE WHEN abs(dif) > 20 THEN 'alta' WHEN abs(dif) > 10 THEN 'moderada' ELSE 'baja' END AS deriva
FROM (SELECT *, {O.rnd("(media_test - media_train) / nullif(media_train, 0) * 100.0")} AS dif FROM (
  SELECT count(*) FILTER (WHERE split = 'train') AS n_train, count(*) FILTER (WHERE split = 'test') AS n_test,
         avg(turistas) FILTER (WHERE split = 'train') AS media_train, avg(turistas) FILTER (WHERE split = 'test') AS media_test
  FROM ms2))"""))
def q_split_drift(spark, d):
    """M2: difference of train and test target means and its band."""
    return FE.split_drift(model_table(spark, d))


@query("target_stats", O.with_extra(["final"], _SPLIT_CTE, f"""
SELECT split, {O.rnd("avg(turistas)", 4)} AS mean, {O.rnd("stddev_samp(turistas)", 4)} AS std,
       CAST(min(turistas) AS DOUBLE) AS min, CAST(max(turistas) AS DOUBLE) AS max,
       {O.rnd("quantile_cont(turistas, 0.5)", 4)} AS median, {O.rnd("quantile_cont(turistas, 0.25)", 4)} AS q25,
       {O.rnd("quantile_cont(turistas, 0.75)", 4)} AS q75
FROM ms2 GROUP BY split"""))
def q_target_stats(spark, d):
    """Q-22: target statistics per split."""
    return FE.target_stats(model_table(spark, d))


def _train_long_sql(value_sql: str) -> str:
    cols = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in NUMERIC)
    return O.with_extra(["final"], _SPLIT_CTE, f"""
SELECT columna, {value_sql}
FROM (SELECT {cols} FROM ms2 WHERE split = 'train') UNPIVOT INCLUDE NULLS (v FOR columna IN (COLUMNS(*)))
GROUP BY columna""")


@query("imputed", _train_long_sql(f"{O.rnd('quantile_cont(v, 0.5)', 6)} AS mediana"))
def q_imputed(spark, d):
    """M3: the exact train medians the imputer fills NULLs with, per numeric feature."""
    t = model_table(spark, d)
    num, _ = feature_lists(t)
    m = FE.MedianImputer(inputCols=num).fit(t.filter(F.col("split") == "train"))
    vals = m.getOrDefault(m.values)
    rows = [(c, v) for c, v in zip(num, vals)]
    return spark.createDataFrame(rows, "columna string, mediana double").select(
        "columna", rint_round(F.col("mediana"), 6).alias("mediana"))


@query("scaled_features", _train_long_sql(
    f"{O.rnd('avg(v)', 6)} AS media, {O.rnd('CASE WHEN coalesce(stddev_pop(v), 0) = 0 THEN 1.0 ELSE stddev_pop(v) END', 6)} AS escala"))
def q_scaled_features(spark, d):
    """M4: the train mean and population std (1 for constants) the scaler uses, per numeric feature."""
    t = model_table(spark, d)
    num, _ = feature_lists(t)
    m = FE.PopulationScaler(inputCols=num).fit(t.filter(F.col("split") == "train"))
    rows = list(zip(num, m.getOrDefault(m.values), m.getOrDefault(m.scales)))
    return spark.createDataFrame(rows, "columna string, media double, escala double").select(
        "columna", rint_round(F.col("media"), 6).alias("media"), rint_round(F.col("escala"), 6).alias("escala"))


@query("feature_check", O.with_extra(["final"], _SPLIT_CTE, f"""
SELECT columna, count(*) FILTER (WHERE v IS NULL) AS nulos, count(*) FILTER (WHERE v = 0) AS ceros, min(v) AS min, max(v) AS max
FROM (SELECT {", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in NUMERIC + ["turistas"])} FROM ms2 WHERE split = 'train')
UNPIVOT INCLUDE NULLS (v FOR columna IN (COLUMNS(*))) GROUP BY columna"""))
def q_feature_check(spark, d):
    """Q-19: nulls, zeros, min and max of each numeric feature and the target on the train rows."""
    t = model_table(spark, d)
    num, cat = feature_lists(t)
    return FE.integrity(t.filter(F.col("split") == "train"), num)


@query("nonfinite_check", O.with_extra(["final"], _SPLIT_CTE, f"""
SELECT CAST(0 AS BIGINT) AS filas_no_finitas, CAST(0 AS BIGINT) AS celdas_no_finitas,
       CAST({len(NUMERIC)} + (SELECT count(DISTINCT pais_origen) FROM ms2 WHERE split = 'train')
            + (SELECT count(DISTINCT punto_entrada) FROM ms2 WHERE split = 'train') AS INTEGER) AS ancho"""))
def q_nonfinite_check(spark, d):
    """Q-20 + M5-M7: the fitted pre-processing output has no NaN/Inf; width = numeric + one-hot levels."""
    t = model_table(spark, d)
    num, cat = feature_lists(t)
    pre = FE.preprocessing_pipeline(num, cat).fit(t.filter(F.col("split") == "train"))
    return FE.nonfinite_report(pre.transform(t))


def _encoded_sql() -> str:
    """Scaled numbers and set levels of every row, by the medians, means and deviations of the train rows."""
    cells = []
    for c in NUMERIC:
        v = f'CAST("{c}" AS DOUBLE)'
        cells.append(f"""
SELECT indice_tiempo, pais_origen, punto_entrada, '{c}' AS feature, {O.rnd("(coalesce(v, med) - m) / s", 6)} + 0.0 AS value
FROM (SELECT *, {v} AS v FROM ms2), (
  SELECT med, avg(w) AS m, CASE WHEN coalesce(stddev_pop(w), 0) = 0 THEN 1.0 ELSE stddev_pop(w) END AS s FROM (
    SELECT med, coalesce({v}, med) AS w FROM ms2, (
      SELECT coalesce(quantile_cont({v}, 0.5), 0.0) AS med FROM ms2 WHERE split = 'train') WHERE split = 'train') GROUP BY med)""")
    for c in CATEGORICAL:
        level = f"coalesce({c}, 'missing')"
        cells.append(f"""
SELECT indice_tiempo, pais_origen, punto_entrada, '{c}=' || {level} AS feature, 1.0 AS value FROM ms2
WHERE {level} IN (SELECT {level} FROM ms2 WHERE split = 'train')""")
    return O.with_extra(["final"], _SPLIT_CTE, " UNION ALL ".join(cells))


@query("encoded_features", _encoded_sql())
def q_encoded_features(spark, d):
    """M3-M7: every row as the models see it, in long form: scaled numbers (6 places) and the levels it has."""
    t = model_table(spark, d)
    num, cat = feature_lists(t)
    pre = FE.preprocessing_pipeline(num, cat).fit(t.filter(F.col("split") == "train"))
    # the encoder replaces the columns of its numbers, not the keys
    return FE.encoded_long(pre, t, num, cat, KEYS).select(*KEYS, "feature", (rint_round("value", 6) + F.lit(0.0)).alias("value"))


# Q-20's own input: a quote of zero in every 50th order makes an infinite inverse price, a missing one none.
@query("nonfinite_rows", """
SELECT count(*) FILTER (o_orderkey % 50 = 0) AS filas_no_finitas,
       CAST(count(*) FILTER (o_orderkey % 50 = 0) + count(*) FILTER (o_orderkey % 100 = 0) AS BIGINT) AS celdas_no_finitas,
       3 AS ancho FROM orders""")
def q_nonfinite_rows(spark, d):
    """Q-20: rows and cells that are not finite, on vectors that hold infinite and undefined numbers."""
    o, key = fx.table(spark, d, "orders"), F.col("o_orderkey")
    inverse = F.when(key % 50 == 0, F.lit(float("inf"))).otherwise(F.lit(1.0) / F.col("o_totalprice"))
    change = F.when(key % 100 == 0, F.lit(float("nan"))).otherwise(F.log("o_totalprice"))
    return FE.nonfinite_report(o.select(array_to_vector(F.array(F.col("o_totalprice"), inverse, change)).alias("features")))


_FITTED: dict = memo()


def _fit_key(spark, d, kind, params):
    import json

    return spark.sparkContext.applicationId, d, input_state(spark, d), kind, json.dumps(params, sort_keys=True)


def _summary(spark, d, kind, params=None):
    """Fit ``kind`` on the train rows (always) and keep the fitted pipeline for this run."""
    t = model_table(spark, d)
    num, cat = feature_lists(t)
    model, pred, summ = MO.evaluate(t, num, cat, kind, params)
    _FITTED[_fit_key(spark, d, kind, params)] = (model, pred, summ)
    return t, pred, summ


def _fitted(spark, d, kind, params=None):
    """The pipeline fitted earlier in this run (the reference fits once, then evaluates and scores); fit if none."""
    got = _FITTED.get(_fit_key(spark, d, kind, params))
    if got is None:
        _summary(spark, d, kind, params)
        got = _FITTED[_fit_key(spark, d, kind, params)]
    return got


@query("ridge_metrics")
def q_ridge_metrics(spark, d):
    """M8a + M10 + M11 + M16: ridge (alpha 1) train/test metrics, overfit ratio and bands (rows-only)."""
    return _summary(spark, d, "ridge")[2]


@query("forest_metrics")
def q_forest_metrics(spark, d):
    """M8b + M10 + M11 + M16: random forest (100 trees, depth 20) metrics (rows-only)."""
    return _summary(spark, d, "forest")[2]


@query("boosting_metrics")
def q_boosting_metrics(spark, d):
    """M8c + M10 + M11 + M16: gradient boosting (100 rounds, rate 0.1, depth 5) metrics (rows-only)."""
    return _summary(spark, d, "boosting")[2]


@query("cross_validation")
def q_cross_validation(spark, d):
    """M9: 5-fold contiguous CV of the three models: RMSE mean/std, R2 mean (rows-only)."""
    t = model_table(spark, d)
    num, cat = feature_lists(t)
    train = t.filter(F.col("split") == "train")
    return reduce(lambda a, b: a.unionByName(b), [
        MO.cross_validate(train, num, cat, kind, [MO.DEFAULT_PARAMS[kind]]).withColumn("modelo", F.lit(kind))
        for kind in ("ridge", "forest", "boosting")])


@query("model_ranking")
def q_model_ranking(spark, d):
    """The three models ranked by test RMSE (rows-only)."""
    return MO.ranking([_fitted(spark, d, k)[2] for k in ("ridge", "forest", "boosting")])


@query("search_best")
def q_search_best(spark, d):
    """M13 + M14: ridge random search (30 draws x 5 folds), the best map, and the keep-or-not decision (rows-only)."""
    t = model_table(spark, d)
    num, cat = feature_lists(t)
    train = t.filter(F.col("split") == "train")
    res = MO.random_search(train, num, cat, "ridge")
    best = res.first()
    import json

    tuned = MO.evaluate(t, num, cat, "ridge", json.loads(best["params"]))[2]
    base = _fitted(spark, d, "ridge")[2]
    dec = MO.keep_tuned(base, tuned)
    return dec.select(F.lit(best["params"]).alias("params"), F.lit(best["cv_rmse"]).alias("cv_rmse"), "*")


@query("residual_stats")
def q_residual_stats(spark, d):
    """Residual statistics of the boosting model on the test rows (rows-only)."""
    return MO.residual_stats(_fitted(spark, d, "boosting")[1])


@query("drift_alert")
def q_drift_alert(spark, d):
    """Monthly test RMSE of the boosting model against 1.5x its overall test RMSE (rows-only)."""
    return MO.drift_alert(_fitted(spark, d, "boosting")[1])


@query("model_roundtrip", O.with_extra(["final"], _SPLIT_CTE, """
SELECT count(*) AS filas, 0.0 AS max_diferencia FROM ms2 WHERE split = 'test'"""))
def q_model_roundtrip(spark, d):
    """S20 + M18: save the fitted pipeline with metadata, load it back, score the test rows: the same numbers."""
    t = model_table(spark, d)
    num, cat = feature_lists(t)
    model, pred, summ = MO.evaluate(t, num, cat, "ridge")
    path = scratch_path(spark, "model")
    MO.save(model, path, summ)
    loaded, meta = MO.load(spark, path)
    again = loaded.transform(t.filter(F.col("split") == "test")).select(*KEYS, F.col("prediction").alias("p2"))
    both = pred.filter(F.col("split") == "test").select(*KEYS, "prediction").join(again, KEYS)
    return both.agg(F.count(F.lit(1)).alias("filas"),
                    F.max(F.abs(F.col("prediction") - F.col("p2"))).alias("max_diferencia"))


# ---------------------------------------------------------------- scenarios

from arrivo.operators import scenario as SC  # noqa: E402

# Fixture scenario: a July inside the data's period, a price inside its range.
SCENARIO = SC.Scenario(year=2001, month=7, price=300000.0)
SCENARIO_ORIGIN = "Nation_0"


def _history(spark, d):
    return pl.curated(spark, d).filter(F.col("turistas") > 0)


def _grid_sql() -> str:
    meds = ", ".join(f'round_even(quantile_cont(CAST("{c}" AS DOUBLE), 0.5) * 1000000.0, 0) / 1000000.0 AS "{c}"'
                     for c in NUMERIC)
    mes = SCENARIO.month
    cal = {"año": float(SCENARIO.year), "mes": float(mes)}
    cal.update({f"es_{m}": float(mes == i + 1) for i, m in enumerate(O.MONTHS)})
    cal.update({"mes_vendimia": float(mes in (2, 3)), "vacaciones_invierno": float(mes in (7, 8)),
                "temporada_alta": float(mes in (1, 2, 3, 7, 8, 12))})
    sel = []
    for c in NUMERIC:
        if c == "precio_promedio_usd":
            sel.append(f'CAST({SCENARIO.price} AS DOUBLE) AS "{c}"')
        elif c in cal:
            sel.append(f'CAST({cal[c]} AS DOUBLE) AS "{c}"')
        else:
            sel.append(f'CAST(med."{c}" AS DOUBLE) AS "{c}"')
    return O.with_extra(["final"], f"""
cur AS (SELECT * FROM final WHERE turistas > 0),
med AS (SELECT {meds} FROM cur)""", f"""
SELECT o.pais_origen, p.punto_entrada, {", ".join(sel)}
FROM (SELECT DISTINCT pais_origen FROM cur) o, (SELECT DISTINCT punto_entrada FROM cur) p, med""")


@query("scenario_grid", _grid_sql())
def q_scenario_grid(spark, d):
    """J5 + M19 + M25: scenario rows for every origin x entry point, other features at their history medians."""
    return SC.grid(_history(spark, d), NUMERIC, CATEGORICAL, SCENARIO)


@query("scenario_domains", O.with_extra(["final"], _SPLIT_CTE, """
SELECT pais_origen, punto_entrada FROM (SELECT DISTINCT pais_origen FROM ms2 WHERE split = 'train')
CROSS JOIN (SELECT DISTINCT punto_entrada FROM ms2 WHERE split = 'train')"""))
def q_scenario_domains(spark, d):
    """The scenario pairs from the domains that a model was trained on (its metadata)."""
    domains = SC.model_domains(model_table(spark, d).filter(F.col("split") == "train"))
    return SC.grid(_history(spark, d), NUMERIC, CATEGORICAL, SCENARIO, metadata=domains).select("pais_origen", "punto_entrada")


def _scored(spark, d, sc):
    t = model_table(spark, d)
    num, cat = feature_lists(t)
    model, pred, summ = _fitted(spark, d, "ridge")
    train = t.filter(F.col("split") == "train")
    mean = train.agg(F.avg(F.col("turistas").cast("double"))).scalar()
    mx = train.agg(F.max(F.col("turistas").cast("double"))).scalar()
    rmse = summ.select("test_rmse").scalar()
    rows = SC.grid(_history(spark, d), num, cat, sc)
    return SC.score(model, rows), mean, mx, rmse


@query("scenario_rollup")
def q_scenario_rollup(spark, d):
    """M18 + M20 + M22-M24: all origins scored once; totals, shares, rank, band and interval (rows-only)."""
    scored, mean, mx, rmse = _scored(spark, d, SCENARIO)
    return SC.rollup(scored, mean, mx, rmse)


@query("scenario_bands")
def q_scenario_bands(spark, d):
    """One origin over every entry point with shares, history comparison, band, interval (rows-only)."""
    sc = SC.Scenario(SCENARIO.year, SCENARIO.month, SCENARIO.price, origin=SCENARIO_ORIGIN)
    scored, mean, mx, rmse = _scored(spark, d, sc)
    return SC.single_origin(scored, mean, mx, rmse)
