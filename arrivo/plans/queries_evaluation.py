"""Driver queries of the evaluation and scenario steps on a predictor that SQL can repeat.

The predictor is the train mean of the target per key (origin and calendar month, or origin), with the overall
train mean where a key was not seen. It goes through the same operators as the fitted models.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrivo.functions import rint_round
from arrivo.operators import features as FE
from arrivo.operators import model as MO
from arrivo.operators import scenario as SC
from arrivo.plans import oracle as O
from arrivo.plans import pipeline as pl
from arrivo.plans.queries import query
from arrivo.plans.queries_model import _SPLIT_CTE, CATEGORICAL, NUMERIC, SCENARIO, SCENARIO_ORIGIN, model_table

KEYS = {"origen_mes": ["pais_origen", "mes"], "origen": ["pais_origen"], "global": []}
ROUNDED = 6


def _rounded(df, *keep):
    """Doubles rounded, so that the order of a sum does not show."""
    return df.select(*[rint_round(c, ROUNDED).alias(c) if t == "double" and c not in keep else F.col(c) for c, t in df.dtypes])


def _pred(spark, d, name):
    return MO.mean_predictor(model_table(spark, d), KEYS[name])


def _pred_sql(name: str) -> str:
    keys = KEYS[name]
    join = f"LEFT JOIN (SELECT {', '.join(keys)}, {O.mean_of('turistas')} AS m FROM ms2 WHERE split = 'train' GROUP BY ALL) k USING ({', '.join(keys)})"
    value = "coalesce(k.m, g.m)" if keys else "g.m"
    return (f"p_{name} AS (SELECT ms2.*, {value} AS prediction FROM ms2 {join if keys else ''}, "
            f"(SELECT {O.mean_of('turistas')} AS m FROM ms2 WHERE split = 'train') g)")


def _summary_sql(name: str) -> str:
    r = lambda x: O.rnd(x, ROUNDED)
    return f"""s_{name} AS (
  SELECT '{name}' AS modelo, train_n, test_n, train_rmse, train_mae, train_r2, test_rmse, test_mae, test_r2,
         test_rmse / train_rmse AS overfitting_ratio, test_rmse / test_media * 100.0 AS error_relativo_pct
  FROM (SELECT count(*) FILTER (split = 'train') AS train_n, count(*) FILTER (split = 'test') AS test_n,
          sqrt(avg(e * e) FILTER (split = 'train')) AS train_rmse, avg(abs(e)) FILTER (split = 'train') AS train_mae,
          1 - sum(e * e) FILTER (split = 'train') / nullif(var_pop(turistas) FILTER (split = 'train') * count(*) FILTER (split = 'train'), 0) AS train_r2,
          sqrt(avg(e * e) FILTER (split = 'test')) AS test_rmse, avg(abs(e)) FILTER (split = 'test') AS test_mae,
          1 - sum(e * e) FILTER (split = 'test') / nullif(var_pop(turistas) FILTER (split = 'test') * count(*) FILTER (split = 'test'), 0) AS test_r2,
          avg(turistas) FILTER (split = 'test') AS test_media
        FROM (SELECT split, turistas, turistas - prediction AS e FROM p_{name}))),
r_{name} AS (
  SELECT modelo, train_n, test_n, {", ".join(f"{r(c)} AS {c}" for c in
         ("train_rmse", "train_mae", "train_r2", "test_rmse", "test_mae", "test_r2", "overfitting_ratio", "error_relativo_pct"))},
         CASE WHEN overfitting_ratio < 1.2 THEN 'excelente' WHEN overfitting_ratio < 1.5 THEN 'buena'
              WHEN overfitting_ratio < 2.5 THEN 'overfitting moderado' ELSE 'overfitting severo' END AS generalizacion,
         CASE WHEN overfitting_ratio < 1.1 THEN 'excelente' WHEN overfitting_ratio < 1.3 THEN 'muy bueno' WHEN overfitting_ratio < 1.5 THEN 'bueno'
              WHEN overfitting_ratio < 2.5 THEN 'moderado' ELSE 'alto' END AS diagnostico,
         CASE WHEN overfitting_ratio < 1.5 THEN 'excelente' WHEN overfitting_ratio < 2.0 THEN 'buena' ELSE 'overfitting moderado' END
              AS generalizacion_final,
         CASE WHEN test_r2 >= 0.9 THEN 'EXCELENTE' WHEN test_r2 >= 0.7 THEN 'MUY BUENO' WHEN test_r2 >= 0.5 THEN 'BUENO'
              WHEN test_r2 >= 0.3 THEN 'REGULAR' ELSE 'BAJO' END AS r2_clase,
         CASE WHEN error_relativo_pct < 30 THEN 'bajo' WHEN error_relativo_pct < 50 THEN 'moderado' ELSE 'alto' END AS error_clase
  FROM s_{name})"""


def _sql(names, body: str, *more: str) -> str:
    parts = [_SPLIT_CTE.strip(), *[x for n in names for x in (_pred_sql(n), _summary_sql(n))], *more]
    return O.with_extra(["final"], ",\n".join(parts), body)


@query("mean_metrics", _sql(["origen_mes"], "SELECT * FROM r_origen_mes"))
def q_mean_metrics(spark, d):
    """M10 + M11 + M16: train and test metrics, overfit ratio, all band sets, relative error."""
    return _rounded(MO.summary(_pred(spark, d, "origen_mes"), "origen_mes"))


@query("mean_ranking", _sql(list(KEYS), "SELECT *, CAST(rank() OVER (ORDER BY test_rmse, modelo) AS INTEGER) AS rank FROM ("
                            + " UNION ALL ".join(f"SELECT * FROM r_{n}" for n in KEYS) + ")"))
def q_mean_ranking(spark, d):
    """Three predictors ranked by test RMSE."""
    return _rounded(MO.ranking([MO.summary(_pred(spark, d, n), n) for n in KEYS]))


@query("mean_decision", _sql(["origen", "origen_mes"], f"""
SELECT o.test_rmse AS o_test_rmse, o.test_r2 AS o_test_r2, o.overfitting_ratio AS o_overfitting_ratio,
       t.test_rmse AS t_test_rmse, t.test_r2 AS t_test_r2, t.overfitting_ratio AS t_overfitting_ratio,
       t.test_rmse < o.test_rmse AND t.overfitting_ratio < 2.0 AS usar_optimizado,
       {O.rnd("(a.test_rmse - b.test_rmse) / a.test_rmse * 100", ROUNDED)} AS mejora_rmse_pct,
       {O.rnd("(b.test_r2 - a.test_r2) / a.test_r2 * 100", ROUNDED)} AS mejora_r2_pct,
       {O.rnd("(b.overfitting_ratio - a.overfitting_ratio) / a.overfitting_ratio * 100", ROUNDED)} AS cambio_overfitting_pct
FROM r_origen o, r_origen_mes t, s_origen a, s_origen_mes b"""))
def q_mean_decision(spark, d):
    """Keep the finer predictor only if its test RMSE improves and its overfit ratio stays below 2."""
    a, b = (MO.summary(_pred(spark, d, n), n) for n in ("origen", "origen_mes"))
    return _rounded(MO.keep_tuned(a, b))


_R = lambda x: O.rnd(x, ROUNDED)


@query("mean_residuals", _sql(["origen_mes"], f"""
SELECT {_R("avg(e)")} AS media, {_R("quantile_cont(e, 0.5)")} AS mediana, {_R("stddev_samp(e)")} AS std,
       {_R("min(e)")} AS min, {_R("max(e)")} AS max, count(*) AS n
FROM (SELECT turistas - prediction AS e FROM p_origen_mes WHERE split = 'test')"""))
def q_mean_residuals(spark, d):
    """Residual statistics on the test rows."""
    return _rounded(MO.residual_stats(_pred(spark, d, "origen_mes")))


@query("mean_drift", _sql(["origen_mes"], f"""
SELECT indice_tiempo, n, {_R("rmse")} AS rmse, {_R("ref")} AS rmse_referencia, rmse > 1.5 * ref AS alerta
FROM (SELECT indice_tiempo, count(*) AS n, sqrt(avg(power(turistas - prediction, 2))) AS rmse FROM p_origen_mes WHERE split = 'test' GROUP BY 1),
     (SELECT sqrt(avg(power(turistas - prediction, 2))) AS ref FROM p_origen_mes WHERE split = 'test')"""))
def q_mean_drift(spark, d):
    """Monthly test RMSE against 1.5 times the overall test RMSE."""
    return _rounded(MO.drift_alert(_pred(spark, d, "origen_mes")))


def _scored(spark, d, sc):
    t = model_table(spark, d)
    rows = SC.grid(pl.curated(spark, d).filter(F.col("turistas") > 0), NUMERIC, CATEGORICAL, sc)
    scored = MO.mean_predictor(t, KEYS["origen_mes"], rows.withColumn("mes", F.col("mes").cast("int")))
    train = t.filter(F.col("split") == "train")
    y = F.col("turistas").cast("double")
    rmse = MO.summary(_pred(spark, d, "origen_mes"), "x").select("test_rmse").scalar()
    return scored, train.agg(F.avg(y)).scalar(), train.agg(F.max(y)).scalar(), rmse


_SCENARIO_SQL = f"""sc AS (
  SELECT pais_origen, punto_entrada, coalesce(k.m, g.m) AS prediction
  FROM (SELECT DISTINCT pais_origen FROM final WHERE turistas > 0) o
  CROSS JOIN (SELECT DISTINCT punto_entrada FROM final WHERE turistas > 0) q
  LEFT JOIN (SELECT pais_origen, {O.mean_of('turistas')} AS m FROM ms2 WHERE split = 'train' AND mes = {SCENARIO.month} GROUP BY 1) k USING (pais_origen)
  CROSS JOIN (SELECT {O.mean_of('turistas')} AS m FROM ms2 WHERE split = 'train') g),
h AS (SELECT avg(turistas) AS media, max(turistas) AS maximo FROM ms2 WHERE split = 'train')"""


def _against_sql(total: str, half: str) -> str:
    return f"""{_R(f"({total} - media) / media * 100")} AS vs_media_pct, {_R(f"{total} / maximo * 100")} AS pct_maximo,
       CASE WHEN {total} > 1.5 * media THEN 'Demanda Muy Alta' WHEN {total} > media THEN 'Demanda Por Encima del Promedio'
            WHEN {total} > 0.7 * media THEN 'Demanda Moderada' ELSE 'Demanda Baja' END AS demanda,
       {_R(f"greatest(0, {total} - {half})")} AS intervalo_inf, {_R(f"{total} + {half}")} AS intervalo_sup"""


@query("mean_rollup", _sql(["origen_mes"], f"""
SELECT pais_origen, puntos, {_R("pred")} AS prediccion, {O.rnd("pred / total * 100", 1)} AS pct_total, CAST(rank AS INTEGER) AS rank, rank <= 5 AS top_5,
       desglose, {_R("total")} AS total, {_R("total / n")} AS promedio_por_pais, {_against_sql("total", "test_rmse * sqrt(n)")}
FROM (SELECT *, rank() OVER (ORDER BY pred DESC, pais_origen) AS rank
      FROM (SELECT pais_origen, count(*) AS puntos, sum(prediction) AS pred,
                   string_agg(punto_entrada || ': ' || CAST(CAST(round_even(prediction, 0) AS BIGINT) AS VARCHAR), ', ' ORDER BY punto_entrada) AS desglose
            FROM sc GROUP BY 1)),
     (SELECT sum(prediction) AS total, count(DISTINCT pais_origen) AS n FROM sc), h, s_origen_mes""", _SCENARIO_SQL))
def q_mean_rollup(spark, d):
    """M20 + M22 to M24: all origins: totals, shares, rank, top 5, breakdown by entry point, history, band, interval."""
    scored, mean, most, rmse = _scored(spark, d, SCENARIO)
    return _rounded(SC.rollup(scored, mean, most, rmse), "pct_total")


@query("mean_single_origin", _sql(["origen_mes"], f"""
SELECT punto_entrada, {_R("prediction")} AS prediccion, {O.rnd("prediction / total * 100", 1)} AS pct_total, {_R("total")} AS total,
       {_against_sql("total", "test_rmse")}
FROM (SELECT * FROM sc WHERE pais_origen = '{SCENARIO_ORIGIN}'), (SELECT sum(prediction) AS total FROM sc WHERE pais_origen = '{SCENARIO_ORIGIN}'), h,
     s_origen_mes""", _SCENARIO_SQL))
def q_mean_single_origin(spark, d):
    """One origin over its entry points."""
    sc = SC.Scenario(SCENARIO.year, SCENARIO.month, SCENARIO.price, origin=SCENARIO_ORIGIN)
    scored, mean, most, rmse = _scored(spark, d, sc)
    return _rounded(SC.single_origin(scored, mean, most, rmse), "pct_total")


@query("ridge_equations", O.with_extra(["final"], _SPLIT_CTE, f"""
SELECT {len(NUMERIC)} + (SELECT count(DISTINCT pais_origen) FROM ms2 WHERE split = 'train')
       + (SELECT count(DISTINCT punto_entrada) FROM ms2 WHERE split = 'train') + 1 AS ecuaciones, true AS todas_cumplidas"""))
def q_ridge_equations(spark, d):
    """The fitted ridge fulfils its normal equations, one per feature and one for the intercept.

    ``X'(y - Xw - b) = alpha w`` and ``sum(y - Xw - b) = 0``, each up to a millionth of the size of its terms.
    """
    t = model_table(spark, d)
    num, cat = FE.feature_columns(t)
    train = t.filter(F.col("split") == "train")
    return MO.normal_equations(MO.fit(train, num, cat, "ridge"), train)


def _oof_sql(name: str) -> str:
    """The metrics of each fold under the means of the other folds, written as a join of every row with the other folds' rows."""
    keys = KEYS[name]
    same = " AND ".join(f"o.{k} IS NOT DISTINCT FROM k.{k}" for k in keys)
    cols = ", ".join(f"{k}" for k in keys)
    value = (f"coalesce((SELECT sum(o.s) / sum(o.n) FROM sums_{name} o WHERE o.fold <> k.fold AND {same}), g.m)" if keys else "g.m")
    return f"""
sums_{name} AS (SELECT {cols + ',' if keys else ''} fold, sum(CAST(turistas AS DOUBLE)) AS s, count(*) AS n FROM folded GROUP BY ALL),
pk_{name} AS (SELECT k.*, {value} AS prediction FROM sums_{name} k, (
  SELECT a.fold, avg(CAST(b.turistas AS DOUBLE)) AS m FROM (SELECT DISTINCT fold FROM folded) a, folded b WHERE b.fold <> a.fold GROUP BY 1) g
  WHERE g.fold = k.fold),
of_{name} AS (
  SELECT '{name}' AS modelo, fold, sqrt(avg(e * e)) AS rmse, 1 - sum(e * e) / nullif(var_pop(turistas) * count(*), 0) AS r2
  FROM (SELECT f.fold, f.turistas, f.turistas - p.prediction AS e FROM folded f JOIN pk_{name} p
        ON f.fold = p.fold {"".join(f" AND f.{k} IS NOT DISTINCT FROM p.{k}" for k in keys)}) GROUP BY fold)"""


_FOLDED = """
folded AS (
  SELECT *, CAST(CASE WHEN pos - 1 < rem * (q + 1) THEN (pos - 1) // (q + 1)
                 ELSE rem + (pos - 1 - rem * (q + 1)) // q END AS INTEGER) AS fold FROM ms2 WHERE split = 'train')"""


@query("mean_cross_validation", O.with_extra(["final"], ",\n".join([_SPLIT_CTE.strip(), _FOLDED, *map(_oof_sql, KEYS)]), f"""
SELECT modelo, folds, {O.rnd("cv_rmse", ROUNDED)} AS cv_rmse, {O.rnd("cv_rmse_std", ROUNDED)} AS cv_rmse_std,
       {O.rnd("cv_r2", ROUNDED)} AS cv_r2, CAST(rank() OVER (ORDER BY cv_rmse, modelo) AS INTEGER) AS position
FROM (SELECT modelo, count(*) AS folds, avg(rmse) AS cv_rmse, stddev_pop(rmse) AS cv_rmse_std, avg(r2) AS cv_r2
      FROM ({" UNION ALL ".join(f"SELECT * FROM of_{n}" for n in KEYS)}) GROUP BY modelo)"""))
def q_mean_cross_validation(spark, d):
    """M9 + M13: contiguous 5-fold validation of three parameter sets of the mean predictor, best first."""
    train = model_table(spark, d).filter(F.col("split") == "train")
    folds = [MO.metrics(MO.out_of_fold_mean(train, KEYS[n]), by="fold").select(F.lit(n).alias("modelo"), "fold", "rmse", "r2") for n in KEYS]
    cv = MO.cv_summary(reduce(DataFrame.unionByName, folds), "modelo")
    # one row per parameter set, so the ranking window is bounded by their number
    ranked = cv.withColumn("position", F.rank().over(Window.orderBy("cv_rmse", "modelo")))
    return _rounded(ranked)
