"""Driver queries for the configuration-declared operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from arrivo.operators import assemble, extras, quality
from arrivo.plans import oracle as O
from arrivo.plans import pipeline as pl
from arrivo.plans.queries import query
from arrivo.plans.queries_sources import _CHECKS_SQL, MIN_ROWS, _checks
from arrivo.sources import fixtures as fx

POINTS = list(fx.QUARTERLY_SOURCES) + list(fx.MONTHLY_SOURCES)


@query("quote_volatility", O.with_(["quotes_clean"], f"""
SELECT indice_tiempo, dias, {O.rnd("s", 4)} AS precio_std, {O.rnd("s / nullif(m, 0) * 100.0", 4)} AS volatilidad_pct,
       CASE WHEN {O.rnd("s / nullif(m, 0) * 100.0", 4)} > 5.0 THEN 'volatil' ELSE 'estable' END AS periodo
FROM (SELECT strftime(fecha, '%Y-%m') AS indice_tiempo, {O.mean_of("venta")} AS m, stddev_samp(venta) AS s,
             count(venta) AS dias FROM quotes_clean GROUP BY 1)"""))
def q_quote_volatility(spark, d):
    """Monthly quote std, volatility percent and class at 5.0."""
    return extras.quote_volatility(pl.clean_quotes(spark, d))


def _shift(p):
    return f"strftime(CAST(strptime(indice_tiempo || '-01', '%Y-%m-%d') + INTERVAL {p} MONTH AS DATE), '%Y-%m')"


@query("lags", O.with_(["fact"], f"""
SELECT f.pais_origen, f.punto_entrada, f.indice_tiempo, f.turistas, a.turistas AS lag_1, b.turistas AS lag_12,
       {O.rnd("(f.turistas - a.turistas) * 1.0 / nullif(a.turistas, 0) * 100.0", 4)} AS crecimiento_1,
       {O.rnd("(f.turistas - b.turistas) * 1.0 / nullif(b.turistas, 0) * 100.0", 4)} AS crecimiento_12
FROM fact f
LEFT JOIN (SELECT pais_origen, punto_entrada, {_shift(1)} AS indice_tiempo, turistas FROM fact) a
  USING (pais_origen, punto_entrada, indice_tiempo)
LEFT JOIN (SELECT pais_origen, punto_entrada, {_shift(12)} AS indice_tiempo, turistas FROM fact) b
  USING (pais_origen, punto_entrada, indice_tiempo)"""))
def q_lags(spark, d):
    """Gap-safe 1- and 12-month lags per (origin, entry point) series and growth against them."""
    return extras.lags(pl.fact(spark, d))


@query("seasonal_ratio", O.with_(["final"], f"""
SELECT f.indice_tiempo, f.pais_origen, f.punto_entrada, f.turistas,
       {O.rnd("f.turistas / nullif(m.mm, 0)", 6)} AS ajuste_estacional
FROM final f JOIN (SELECT pais_origen, punto_entrada, mes, avg(CAST(turistas AS DOUBLE)) AS mm FROM final GROUP BY 1, 2, 3) m
  USING (pais_origen, punto_entrada, mes)"""))
def q_seasonal_ratio(spark, d):
    """D3: visitors over the same calendar month's mean of the series."""
    s = extras.seasonal_ratio(pl.curated(spark, d))
    return s.select(*assemble.KEYS, "turistas", "ajuste_estacional")


def _class_sql(value: str, labels: list[str], table: str) -> str:
    k = len(labels)
    qs = ", ".join(f"quantile_cont(CAST({value} AS DOUBLE), {i / k})" for i in range(1, k))
    whens = " ".join(f"WHEN {value} <= e[{i + 1}] THEN '{labels[i]}'" for i in range(k - 1))
    return f"CASE WHEN {value} IS NULL THEN NULL {whens} ELSE '{labels[-1]}' END", f"(SELECT [{qs}] AS e FROM {table})"


@query("price_classes", O.with_(["quotes_monthly", "fact"], """
SELECT q.indice_tiempo, q.precio_promedio_usd, {pc} AS clase_precio
FROM quotes_monthly q, {pe} qe""".format(
    pc=_class_sql("q.precio_promedio_usd", extras.PRICE_CLASSES, "quotes_monthly")[0].replace("e[", "qe.e["),
    pe=_class_sql("precio_promedio_usd", extras.PRICE_CLASSES, "quotes_monthly")[1])))
def q_price_classes(spark, d):
    """Monthly prices in four quantile classes."""
    q = pl.quotes_monthly(spark, d).select("indice_tiempo", "precio_promedio_usd")
    return extras.quantile_classes(q, "precio_promedio_usd", extras.PRICE_CLASSES, "clase_precio")


@query("demand_classes", O.with_(["fact"], """
SELECT f.indice_tiempo, f.pais_origen, f.punto_entrada, f.turistas, {dc} AS clase_demanda
FROM fact f, {de} fe""".format(
    dc=_class_sql("f.turistas", extras.DEMAND_CLASSES, "fact")[0].replace("e[", "fe.e["),
    de=_class_sql("turistas", extras.DEMAND_CLASSES, "fact")[1])))
def q_demand_classes(spark, d):
    """Fact rows in five quantile demand classes."""
    return extras.quantile_classes(pl.fact(spark, d), "turistas", extras.DEMAND_CLASSES, "clase_demanda")


@query("pivot_points", O.with_(["fact"], "SELECT indice_tiempo, " + ", ".join(
    f"CAST(sum(turistas) FILTER (WHERE punto_entrada = '{p}') AS BIGINT) AS \"{p}\"" for p in POINTS)
    + ", CAST(sum(turistas) AS BIGINT) AS total FROM fact GROUP BY 1"))
def q_pivot_points(spark, d):
    """Wide monthly table, one column per entry point plus the total."""
    return extras.pivot_points(pl.fact(spark, d), POINTS)


@query("price_rules", O.with_(["quotes_clean"], f"""
SELECT d.casa, d.dia, {O.rnd("d.precio", 4)} AS precio, d.precio >= 10.0 AND d.precio <= 3000.0 AS en_rango,
       {O.rnd("(d.precio - p.precio) / nullif(p.precio, 0) * 100.0", 4)} AS cambio_pct,
       coalesce(abs({O.rnd("(d.precio - p.precio) / nullif(p.precio, 0) * 100.0", 4)}) <= 50.0, true) AS cambio_ok,
       date_diff('day', l.ultimo, DATE '{pl.DEFAULT.run_ts[:10]}') <= 7 AS reciente
FROM (SELECT casa, CAST(fecha AS DATE) AS dia, {O.mean_of("venta")} AS precio FROM quotes_clean GROUP BY 1, 2) d
LEFT JOIN (SELECT casa, CAST(fecha AS DATE) + 1 AS dia, {O.mean_of("venta")} AS precio FROM quotes_clean GROUP BY 1, 2) p
  USING (casa, dia)
JOIN (SELECT casa, max(CAST(fecha AS DATE)) AS ultimo FROM quotes_clean GROUP BY 1) l USING (casa)"""))
def q_price_rules(spark, d):
    """Per house and day, price range [10, 3000], day-over-day change within 50%, recent data."""
    return extras.price_rules(pl.clean_quotes(spark, d), run_ts=pl.DEFAULT.run_ts[:10])


@query("month_gaps", O.with_(["fact"], """
SELECT s.punto_entrada, strftime(m.d, '%Y-%m') AS indice_tiempo
FROM (SELECT DISTINCT punto_entrada FROM fact) s,
     (SELECT unnest(generate_series(strptime(min(indice_tiempo) || '-01', '%Y-%m-%d'),
                                    strptime(max(indice_tiempo) || '-01', '%Y-%m-%d'), INTERVAL 1 MONTH)) AS d FROM fact) m
WHERE NOT EXISTS (SELECT 1 FROM fact f WHERE f.punto_entrada = s.punto_entrada AND f.indice_tiempo = strftime(m.d, '%Y-%m'))"""))
def q_month_gaps(spark, d):
    """Months without any record per entry point (calendar left-anti join)."""
    return extras.month_gaps(pl.fact(spark, d))


@query("run_metrics", O.with_extra(["final", "fact"], _CHECKS_SQL + """,
pairs AS (SELECT DISTINCT punto_entrada, indice_tiempo FROM fact),
span AS (SELECT date_diff('month', CAST(min(indice_tiempo) || '-01' AS DATE), CAST(max(indice_tiempo) || '-01' AS DATE)) + 1 AS n FROM fact)""", f"""
SELECT (SELECT success_rate FROM ready) AS success_rate,
       (SELECT {O.rnd("count(precio_promedio_usd) * 100.0 / count(*)")} FROM final) AS cobertura_precio_pct,
       (SELECT {O.rnd("count(interes_google_promedio) * 100.0 / count(*)")} FROM final) AS cobertura_interes_pct,
       (SELECT {O.rnd("count(*) * 100.0 / (any_value(n) * count(DISTINCT punto_entrada))")} FROM pairs, span) AS completitud_pct"""))
def q_run_metrics(spark, d):
    """Success rate, side-table coverage and month completeness in one row."""
    c = _checks(spark, d)
    ready = quality.readiness(c, quality.issues(c, MIN_ROWS))
    fact = pl.fact(spark, d)
    return extras.run_metrics(ready, assemble.join_coverage(pl.final(spark, d)), extras.month_gaps(fact), fact)


@query("fact_with_mean", O.with_(["std"], f"""
SELECT indice_tiempo, pais_origen, punto_entrada, CAST(sum(turistas) AS BIGINT) AS turistas,
       {O.rnd("avg(turistas)", 6)} AS turistas_promedio FROM std GROUP BY 1, 2, 3"""))
def q_fact_with_mean(spark, d):
    """The monthly fact with the mean beside the sum."""
    f = assemble.monthly_fact(pl.standardised(spark, d), with_mean=True)
    return f.withColumn("turistas_promedio", F.rint(F.col("turistas_promedio") * 1e6) / 1e6)


# ---------------------------------------------------------------- streaming landing

@query("incremental_landing", O.with_([], "SELECT 'r1' AS run_date, count(*) AS records, count(DISTINCT o_orderkey) AS orders FROM orders"))
def q_incremental_landing(spark, d):
    """S5 + S7 + S18: land the quote feed twice through a file stream; the second run lands nothing new.

    Returns the landed table's records per run date (read back from the sink).
    """
    from arrivo.session import scratch_path
    from arrivo.streaming import land_new_files

    root = scratch_path(spark, "landing")
    src = fx.table(spark, d, "orders")
    for run in ("r1", "r2"):
        land_new_files(spark, f"{d}/orders.parquet", src.schema, f"{root}/sink", f"{root}/ckpt", run)
    landed = spark.read.parquet(f"{root}/sink")
    return landed.groupBy(F.col("run_date").cast("string").alias("run_date")).agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("o_orderkey").alias("orders"))


_LINE_ORDER = ["l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("line_positions", f"""
SELECT {", ".join(_LINE_ORDER)}, row_number() OVER (ORDER BY {", ".join(f"{c} NULLS FIRST" for c in _LINE_ORDER)}) AS pos FROM lineitem""")
def q_line_positions(spark, d):
    """W5 + O1: the global position of every line, where the first key has three values and one holds half of the rows."""
    lines = fx.table(spark, d, "lineitem").select(*_LINE_ORDER)
    return assemble.positional_rank(lines, _LINE_ORDER, limit=10_000)
