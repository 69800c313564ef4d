"""Driver queries for reports (A5-A21, O1-O4) and profiles (Q-1 to Q-12, Q-21, Q-23)."""

from __future__ import annotations

from pyspark.sql import functions as F

from arrivo.operators import assemble, clean, profile, reports
from arrivo.plans import oracle as O
from arrivo.plans import pipeline as pl
from arrivo.plans.queries import query
from arrivo.sources import fixtures as fx

KEYS = assemble.KEYS
# Fixture choices standing in for the reference's named origins (Chile, Brasil, Uruguay / Brasil, Europa).
SELECTED = ["Nation_0", "Nation_1", "Nation_2"]
PAIR = ["Nation_1", "Nation_2"]
_IN = lambda xs: "(" + ", ".join(f"'{x}'" for x in xs) + ")"

def curated(spark, d):
    """The dashboard's table: the curated table without zero-visitor rows."""
    return pl.curated(spark, d).filter(F.col("turistas") > 0)


# ====================================================================== reports

@query("totals_by_point", O.with_(["final"], """
SELECT punto_entrada, CAST(sum(turistas) AS BIGINT) AS turistas, count(*) AS registros FROM final GROUP BY 1"""))
def q_totals_by_point(spark, d):
    """A5: visitors and rows per entry point."""
    return reports.totals_by(pl.curated(spark, d), ["punto_entrada"], with_count=True)


@query("top_pairs", O.with_(["final"], """
SELECT pais_origen, punto_entrada, CAST(sum(turistas) AS BIGINT) AS turistas FROM final
GROUP BY 1, 2 ORDER BY turistas DESC, pais_origen, punto_entrada LIMIT 5"""))
def q_top_pairs(spark, d):
    """Top 5 (origin, entry point) by visitors."""
    return reports.top_k(pl.curated(spark, d), ["pais_origen", "punto_entrada"], 5)


@query("by_month", O.with_(["final"], """
SELECT mes, CAST(sum(turistas) AS BIGINT) AS turistas FROM final GROUP BY 1"""))
def q_by_month(spark, d):
    """Visitors per calendar month over all years."""
    return reports.totals_by(pl.curated(spark, d), ["mes"])


@query("top_origins", O.with_(["final"], """
SELECT pais_origen, CAST(sum(turistas) AS BIGINT) AS turistas FROM final
GROUP BY 1 ORDER BY turistas DESC, pais_origen LIMIT 6"""))
def q_top_origins(spark, d):
    """Top 6 origins."""
    return reports.top_k(pl.curated(spark, d), ["pais_origen"], 6)


@query("yearly_selected", O.with_(["final"], f"""
SELECT pais_origen, "año", CAST(sum(turistas) AS BIGINT) AS turistas FROM final
WHERE pais_origen IN {_IN(SELECTED)} GROUP BY 1, 2"""))
def q_yearly_selected(spark, d):
    """A9 + C22: yearly visitors of chosen origins, one grouped query for all of them."""
    f = clean.filter_values(pl.curated(spark, d), "pais_origen", SELECTED)
    return reports.totals_by(f, ["pais_origen", "año"])


@query("month_by_origin", O.with_(["final"], f"""
SELECT mes, pais_origen, CAST(sum(turistas) AS BIGINT) AS turistas FROM final
WHERE pais_origen IN {_IN(PAIR)} GROUP BY 1, 2"""))
def q_month_by_origin(spark, d):
    """A10: visitors by (month, origin) for two chosen origins."""
    f = clean.filter_values(pl.curated(spark, d), "pais_origen", PAIR)
    return reports.totals_by(f, ["mes", "pais_origen"])


@query("top8_origins", O.with_(["final"], """
SELECT pais_origen, CAST(sum(turistas) AS BIGINT) AS turistas FROM final WHERE turistas > 0
GROUP BY 1 ORDER BY turistas DESC, pais_origen LIMIT 8"""))
def q_top8_origins(spark, d):
    """Top 8 origins of the dashboard table."""
    return reports.top_k(curated(spark, d), ["pais_origen"], 8)


@query("seasonality", O.with_(["final"], f"""
SELECT pais_origen, mes, {O.mean_of("turistas")} AS turistas_promedio
FROM final WHERE turistas > 0 GROUP BY 1, 2"""))
def q_seasonality(spark, d):
    """Mean visitors per (origin, calendar month), every origin at once."""
    return reports.mean_by(curated(spark, d), ["pais_origen", "mes"])


@query("season_peak", O.with_(["final"], f"""
SELECT pais_origen,
       arg_min(mes, struct_pack(a := -turistas_promedio, b := mes)) AS mes_pico, max(turistas_promedio) AS turistas_pico,
       arg_min(mes, struct_pack(a := turistas_promedio, b := mes)) AS mes_bajo, min(turistas_promedio) AS turistas_bajo,
       {O.rnd("avg(turistas_promedio)", 6)} AS promedio,
       {O.rnd("(max(turistas_promedio) - min(turistas_promedio)) / nullif(min(turistas_promedio), 0) * 100.0")} AS variacion_pct
FROM (SELECT pais_origen, mes, {O.mean_of("turistas")} AS turistas_promedio
      FROM final WHERE turistas > 0 GROUP BY 1, 2) GROUP BY 1"""))
def q_season_peak(spark, d):
    """best/worst month per origin (ties: earliest month), spread percent, mean of monthly means."""
    return reports.season_peak(curated(spark, d))


_BOX_CTES = """
long AS (SELECT 'vacaciones_invierno' AS flag, vacaciones_invierno AS level, CAST(turistas AS DOUBLE) AS v FROM final
         UNION ALL SELECT 'mes_vendimia', mes_vendimia, CAST(turistas AS DOUBLE) FROM final),
q AS (SELECT flag, level, count(v) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS mediana,
             quantile_cont(v, 0.75) AS q3, min(v) AS minimo, max(v) AS maximo FROM long GROUP BY 1, 2)"""
_BOX_SQL = """
SELECT q.*, w.bigote_inf, w.bigote_sup, w.atipicos FROM q JOIN (
  SELECT l.flag, l.level,
         min(CASE WHEN v >= q1 - 1.5 * (q3 - q1) THEN v END) AS bigote_inf,
         max(CASE WHEN v <= q3 + 1.5 * (q3 - q1) THEN v END) AS bigote_sup,
         count(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS atipicos
  FROM long l JOIN q USING (flag, level) GROUP BY 1, 2) w USING (flag, level)"""


@query("box_stats", O.with_extra(["final"], _BOX_CTES, _BOX_SQL))
def q_box_stats(spark, d):
    """Quartiles, whiskers and outliers of visitors by winter-break and harvest flags."""
    return reports.box_stats(pl.curated(spark, d), ["vacaciones_invierno", "mes_vendimia"])


@query("distincts", O.with_(["final"], """
SELECT count(DISTINCT indice_tiempo) AS n_indice_tiempo, count(DISTINCT pais_origen) AS n_pais_origen,
       count(DISTINCT punto_entrada) AS n_punto_entrada, count(DISTINCT "año") AS "n_año" FROM final"""))
def q_distincts(spark, d):
    """Distinct months, origins, entry points and years."""
    return reports.distinct_counts(pl.curated(spark, d), ["indice_tiempo", "pais_origen", "punto_entrada", "año"])


@query("source_summary", O.with_(["std"], f"""
SELECT src, count(*) AS filas, CAST(sum(turistas) AS BIGINT) AS turistas_total, min(turistas) AS turistas_min,
       max(turistas) AS turistas_max, {O.mean_of("turistas")} AS turistas_promedio,
       min(punto_entrada) AS punto_entrada, min(fecha_std) AS desde, max(fecha_std) AS hasta
FROM std GROUP BY 1"""))
def q_source_summary(spark, d):
    """A17 + A20: per-source rows, totals, extremes, mean, entry point and period."""
    return reports.source_summary(pl.standardised(spark, d))


@query("date_range", O.with_(["quotes_monthly"], f"""
SELECT min(indice_tiempo) AS desde, max(indice_tiempo) AS hasta, count(*) AS filas,
       {O.rnd(O.mean_of("precio_promedio_usd"))} AS precio_promedio_usd_promedio,
       {O.rnd("quantile_cont(precio_promedio_usd, 0.5)", 6)} AS precio_promedio_usd_mediana,
       {O.rnd(O.mean_of("variacion_usd_mensual"))} AS variacion_usd_mensual_promedio,
       {O.rnd("quantile_cont(variacion_usd_mensual, 0.5)", 6)} AS variacion_usd_mensual_mediana,
       min(indice_tiempo) || ' - ' || max(indice_tiempo) AS rango
FROM quotes_monthly"""))
def q_date_range(spark, d):
    """Period covered by the monthly quote table and averages of its columns."""
    return reports.date_range(pl.quotes_monthly(spark, d), values=["precio_promedio_usd", "variacion_usd_mensual"])


@query("category_counts", O.with_(["final"], """
SELECT pais_origen AS valor, count(*) AS n, round_even(count(*) * 100.0 / (SELECT count(*) FROM final) * 100.0, 0) / 100.0 AS pct
FROM final GROUP BY 1"""))
def q_category_counts(spark, d):
    """Origin value counts with percent."""
    return reports.value_counts(pl.curated(spark, d), "pais_origen")


@query("head_rows", O.with_(["final"], """
SELECT * FROM final ORDER BY indice_tiempo, pais_origen, punto_entrada LIMIT 10"""))
def q_head_rows(spark, d):
    """O1 + O2: the first 10 rows of the table in (month, origin, entry point) order."""
    return reports.head(pl.curated(spark, d), 10, KEYS)


@query("sample_rows", O.with_(["final"], """
SELECT * FROM final
ORDER BY md5(concat_ws('|', indice_tiempo, pais_origen, punto_entrada, '42')), indice_tiempo, pais_origen, punto_entrada
LIMIT 100"""))
def q_sample_rows(spark, d):
    """100 rows chosen by a seeded md5 of the keys."""
    return reports.sample_rows(pl.curated(spark, d), 100, KEYS)


# ====================================================================== profiles

FINAL_NUMERIC = [
    "turistas", "precio_promedio_usd", "precio_minimo_usd", "precio_maximo_usd", "dias",
    "variacion_usd_mensual", "variacion_porcentual_usd", "usd_alto", "usd_alta_variabilidad",
    "interes_google_promedio", "interes_alto", "año", "mes",
    *[f"es_{m}" for m in O.MONTHS], "mes_vendimia", "vacaciones_invierno", "temporada_alta",
]


def _casted(cols):
    return ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in cols)


@query("describe", O.with_(["final"], f"""
SELECT columna, count(v) AS count, {O.rnd(O.mean_of("v"), 6)} AS mean,
       {O.rnd(O.std_of("v"), 6)} AS std, min(v) AS min,
       {O.rnd("quantile_cont(v, 0.25)", 6)} AS q25, {O.rnd("quantile_cont(v, 0.5)", 6)} AS q50,
       {O.rnd("quantile_cont(v, 0.75)", 6)} AS q75, max(v) AS max
FROM (SELECT {_casted(FINAL_NUMERIC)} FROM final) UNPIVOT INCLUDE NULLS (v FOR columna IN (COLUMNS(*)))
GROUP BY 1"""))
def q_describe(spark, d):
    """Q-1: describe every numeric column in one aggregate."""
    return profile.describe(pl.curated(spark, d))


@query("target_profile", O.with_(["final"], f"""
SELECT media, mediana, desviacion, minimo, maximo, maximo - minimo AS rango, cv_pct,
       CASE WHEN cv_pct > 100 THEN 'alta' WHEN cv_pct > 50 THEN 'moderada' ELSE 'baja' END AS variabilidad
FROM (SELECT *, {O.rnd("desviacion / nullif(media, 0) * 100.0")} AS cv_pct FROM (
  SELECT {O.mean_of("turistas")} AS media, quantile_cont(CAST(turistas AS DOUBLE), 0.5) AS mediana,
         {O.rnd(O.std_of("turistas"), 6)} AS desviacion,
         CAST(min(turistas) AS DOUBLE) AS minimo, CAST(max(turistas) AS DOUBLE) AS maximo FROM final))"""))
def q_target_profile(spark, d):
    """Q-2: target statistics, coefficient of variation and its band."""
    return profile.target_profile(pl.curated(spark, d))


_KIND_COLS = [c for c in FINAL_NUMERIC if c != "turistas"]


@query("column_kinds", O.with_(["final"], " UNION ALL ".join(
    [f"SELECT '{c}' AS columna, 'numerica' AS tipo, count(DISTINCT \"{c}\") AS n_distintos FROM final" for c in _KIND_COLS]
    + [f"SELECT '{c}', 'categorica', count(DISTINCT \"{c}\") FROM final" for c in ("pais_origen", "punto_entrada")])))
def q_column_kinds(spark, d):
    """Q-3: feature columns by kind (target and date columns removed) with cardinality."""
    return profile.column_kinds(pl.curated(spark, d))


_ALL_FINAL = ["indice_tiempo", "pais_origen", "punto_entrada"] + FINAL_NUMERIC


@query("null_report", O.with_(["final"], f"""
SELECT columna, nulos, round_even(nulos * 100.0 / filas * 100.0, 0) / 100.0 AS pct FROM (
  SELECT columna, count(*) FILTER (WHERE v IS NULL) AS nulos, count(*) AS filas
  FROM (SELECT {", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in _ALL_FINAL)} FROM final)
       UNPIVOT INCLUDE NULLS (v FOR columna IN (COLUMNS(*))) GROUP BY 1) WHERE nulos > 0"""))
def q_null_report(spark, d):
    """Q-4: columns with nulls, count and percent."""
    return profile.null_report(pl.curated(spark, d))


@query("quality_nulls", O.with_([], """
SELECT columna, nulos, round_even(nulos * 100.0 / filas * 100.0, 0) / 100.0 AS pct FROM (
  SELECT columna, count(*) FILTER (WHERE v IS NULL) AS nulos, count(*) AS filas
  FROM (SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source, CAST(n_chars AS VARCHAR) AS n_chars,
               CAST(quality AS VARCHAR) AS quality, CAST(toxic AS VARCHAR) AS toxic
        FROM documents LEFT JOIN labels USING (doc_id))
       UNPIVOT INCLUDE NULLS (v FOR columna IN (COLUMNS(*))) GROUP BY 1) WHERE nulos > 0"""))
def q_quality_nulls(spark, d):
    """Q-4 on documents left-joined to labels: unlabelled documents give NULL quality and toxicity."""
    return profile.null_report(fx.quality_docs(spark, d))


@query("duplicates", O.with_([], """
SELECT CAST(sum(n) AS BIGINT) AS filas, CAST(sum(n - 1) AS BIGINT) AS duplicados,
       round_even(sum(n - 1) * 100.0 / sum(n) * 100.0, 0) / 100.0 AS pct
FROM (SELECT count(*) AS n FROM documents d LEFT JOIN labels l USING (doc_id)
      GROUP BY d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic)"""))
def q_duplicates(spark, d):
    """Q-5: exact duplicate rows (all columns but the id) of the labelled documents, whole texts compared."""
    docs = fx.table(spark, d, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    q = profile.with_digests(docs, ["text"]).join(fx.table(spark, d, "labels"), "doc_id", "left").drop("doc_id")
    return profile.duplicates(q)


@query("iqr_outliers", O.with_(["final"], """
SELECT q1, q3, iqr, limite_inferior, limite_superior,
       (SELECT count(*) FROM final WHERE turistas < limite_inferior OR turistas > limite_superior) AS atipicos,
       round_even((SELECT count(*) FROM final WHERE turistas < limite_inferior OR turistas > limite_superior) * 100.0
                  / (SELECT count(*) FROM final) * 100.0, 0) / 100.0 AS pct
FROM (SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS limite_inferior, q3 + 1.5 * (q3 - q1) AS limite_superior
      FROM (SELECT quantile_cont(CAST(turistas AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(turistas AS DOUBLE), 0.75) AS q3 FROM final))"""))
def q_iqr_outliers(spark, d):
    """Q-6: IQR bounds and outlier count."""
    return profile.iqr_outliers(pl.curated(spark, d))


@query("top_outliers", O.with_(["final"], """
SELECT "año", mes, pais_origen, punto_entrada, turistas FROM final
WHERE turistas > (SELECT quantile_cont(CAST(turistas AS DOUBLE), 0.75) + 1.5 * (quantile_cont(CAST(turistas AS DOUBLE), 0.75)
                                                             - quantile_cont(CAST(turistas AS DOUBLE), 0.25)) FROM final)
ORDER BY turistas DESC, indice_tiempo, pais_origen, punto_entrada LIMIT 5"""))
def q_top_outliers(spark, d):
    """Q-7 + O3: the five largest upper outliers with context."""
    return profile.top_outliers(pl.curated(spark, d))


@query("zero_share", O.with_(["final"], """
SELECT count(*) FILTER (WHERE turistas = 0) AS ceros, count(*) AS filas,
       round_even(count(*) FILTER (WHERE turistas = 0) * 100.0 / count(*) * 100.0, 0) / 100.0 AS pct FROM final"""))
def q_zero_share(spark, d):
    """Q-8: zero-visitor rows and share."""
    return profile.zero_share(pl.curated(spark, d))


@query("zero_by_year", O.with_extra(["final"], """
z AS (SELECT "año", count(*) FILTER (WHERE turistas = 0) AS ceros, count(*) AS filas,
             round_even(count(*) FILTER (WHERE turistas = 0) * 100.0 / count(*) * 100.0, 0) / 100.0 AS pct
      FROM final GROUP BY 1 HAVING count(*) FILTER (WHERE turistas = 0) > 0)""", """
SELECT "año", ceros, filas, pct, "año" = (SELECT arg_min("año", struct_pack(a := -ceros, b := "año")) FROM z) AS peor
FROM z"""))
def q_zero_by_year(spark, d):
    """Q-9: zeros per year with the year's share; the worst year flagged (ties: earliest)."""
    z = profile.zero_by(pl.curated(spark, d), "año")
    worst = profile.worst_key(z, "año").select("año").scalar()
    return z.withColumn("peor", F.col("año") == worst)


@query("zero_by_category", O.with_(["final"], """
SELECT pais_origen, count(*) AS ceros FROM final WHERE turistas = 0
GROUP BY 1 ORDER BY ceros DESC, pais_origen LIMIT 5"""))
def q_zero_by_category(spark, d):
    """Q-10: the five origins with most zero rows."""
    return profile.top_zero(pl.curated(spark, d), "pais_origen")


def _corr_sql(target_only: bool) -> str:
    cols = FINAL_NUMERIC
    ords = ", ".join(f"('{c}', {i})" for i, c in enumerate(cols))
    body = f"""
SELECT a.columna AS columna_a, b.columna AS columna_b, {O.rnd("corr(a.v, b.v)", 6)} AS correlacion
FROM lng a JOIN lng b ON a.rid = b.rid
JOIN ords oa ON oa.columna = a.columna JOIN ords ob ON ob.columna = b.columna
WHERE oa.o < ob.o AND a.columna IN (SELECT columna FROM keep) AND b.columna IN (SELECT columna FROM keep)
GROUP BY 1, 2"""
    pre = f"""base AS (SELECT row_number() OVER () AS rid, * FROM final WHERE turistas > 0),
lng AS (SELECT * FROM (SELECT rid, {_casted(cols)} FROM base) UNPIVOT INCLUDE NULLS (v FOR columna IN (COLUMNS(* EXCLUDE (rid))))),
ords AS (SELECT * FROM (VALUES {ords}) t(columna, o)),
keep AS (SELECT columna FROM lng GROUP BY 1
         HAVING count(DISTINCT v) + max(CASE WHEN v IS NULL THEN 1 ELSE 0 END) > 1
            AND stddev_samp(v) IS NOT NULL AND stddev_samp(v) <> 0 AND columna <> 'interes_alto'),
pairs AS ({body})"""
    if target_only:
        tail = """
SELECT CASE WHEN columna_a = 'turistas' THEN columna_b ELSE columna_a END AS columna, correlacion FROM pairs
WHERE (columna_a = 'turistas' OR columna_b = 'turistas') AND correlacion IS NOT NULL
ORDER BY correlacion DESC, columna LIMIT 10"""
    else:
        tail = "\nSELECT * FROM pairs"
    return O.with_extra(["final"], pre, tail)


@query("correlations", _corr_sql(False))
def q_correlations(spark, d):
    """Q-11: all pairwise correlations of non-constant numeric columns (one aggregate)."""
    return profile.correlations(curated(spark, d))


@query("top_correlations", _corr_sql(True))
def q_top_correlations(spark, d):
    """Q-12: the ten columns most correlated with visitors."""
    return profile.target_correlations(curated(spark, d))


@query("category_catalog", O.with_(["final"], """
SELECT columna, valor, n, round_even(n * 100.0 / (SELECT count(*) FROM final WHERE turistas > 0) * 100.0, 0) / 100.0 AS pct FROM (
  SELECT 'pais_origen' AS columna, pais_origen AS valor, count(*) AS n FROM final WHERE turistas > 0 GROUP BY 2
  UNION ALL
  SELECT 'punto_entrada', punto_entrada, count(*) FROM final WHERE turistas > 0 GROUP BY 2)"""))
def q_category_catalog(spark, d):
    """Q-21: categories with counts and shares (the model metadata's domains)."""
    return profile.category_catalog(curated(spark, d), ["pais_origen", "punto_entrada"])


@query("shape", O.with_(["final"], f"SELECT count(*) AS filas, {len(_ALL_FINAL)} AS columnas FROM final"))
def q_shape(spark, d):
    """Q-23: rows and columns."""
    return profile.shape(pl.curated(spark, d))


@query("correlation_exclusions", O.with_(["final"], f"""
SELECT columna, CASE WHEN columna = 'interes_alto' THEN 'excluida' WHEN count(v) < 2 THEN 'sin_datos'
                     WHEN min(v) = max(v) THEN 'constante' END AS motivo
FROM (SELECT {_casted(FINAL_NUMERIC)} FROM final WHERE turistas > 0) UNPIVOT INCLUDE NULLS (v FOR columna IN (COLUMNS(*)))
GROUP BY columna
HAVING columna = 'interes_alto' OR count(v) < 2 OR min(v) = max(v)"""))
def q_correlation_exclusions(spark, d):
    """Numeric columns kept out of the correlation matrix and why."""
    return profile.correlation_exclusions(curated(spark, d))


@query("zero_removal", O.with_(["final"], f"""
SELECT count(*) AS rows_before, count(*) FILTER (WHERE turistas > 0) AS rows_after,
       count(*) - count(*) FILTER (WHERE turistas > 0) AS rows_removed,
       {O.rnd("(count(*) - count(*) FILTER (WHERE turistas > 0)) * 100.0 / count(*)", 4)} AS pct_removed,
       {O.rnd("avg(turistas)", 4)} AS mean_before, {O.rnd("avg(turistas) FILTER (WHERE turistas > 0)", 4)} AS mean_after,
       {O.rnd("stddev_samp(turistas)", 4)} AS std_before,
       {O.rnd("stddev_samp(turistas) FILTER (WHERE turistas > 0)", 4)} AS std_after
FROM final"""))
def q_zero_removal(spark, d):
    """Rows removed for a zero target, and mean and std before and after (one conditional aggregate)."""
    from arrivo.operators import clean

    from arrivo.functions import rint_round

    r = clean.zero_target_report(pl.curated(spark, d))
    stats = ("pct_removed", "mean_before", "mean_after", "std_before", "std_after")
    return r.select("rows_before", "rows_after", "rows_removed", *[rint_round(F.col(c), 4).alias(c) for c in stats])


@query("scatter_summary", O.with_(["final"], f"""
SELECT pais_origen, count(*) AS n, {O.rnd("corr(CAST(precio_promedio_usd AS DOUBLE), CAST(turistas AS DOUBLE))", 6)} AS corr
FROM final WHERE pais_origen IN {_IN(SELECTED)} GROUP BY 1"""))
def q_scatter_summary(spark, d):
    """C26 + C22: price vs visitors pairs of chosen origins, summarised by a correlation per origin."""
    from arrivo.functions import rint_round
    from arrivo.operators import clean

    s = clean.scatter_pairs(pl.curated(spark, d), "precio_promedio_usd", "turistas", "pais_origen", SELECTED)
    return s.select("pais_origen", "n", rint_round(F.col("corr"), 6).alias("corr"))


@query("quote_feed_status", O.with_(["quotes_clean"], """
SELECT count(*) AS records, CASE WHEN count(*) > 0 THEN 'processed' ELSE 'error' END AS status FROM quotes_clean"""))
def q_quote_feed_status(spark, d):
    """The quote feed is accepted only when rows survive the filters."""
    from arrivo.operators import clean

    return clean.quote_feed_status(pl.clean_quotes(spark, d))
