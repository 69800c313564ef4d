"""Driver queries: one callable ``(spark, sf_dir) -> DataFrame`` per survey ID group, with SQL twins.

``QUERIES`` and ``ORACLE`` are filled by the ``query`` decorator; keys match.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivo.functions import clean_text, month_key, normalise_month_key, number_or_zero, parse_ts, safe_number
from arrivo.operators import assemble, calendar, clean
from arrivo.operators.counters import RunCounters
from arrivo.plans import oracle as O
from arrivo.plans import pipeline as pl
from arrivo.sources import catalog
from arrivo.sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ====================================================================== calendar

@query("quarter_to_month", O.with_(["landed"], f"""
SELECT x.src, x.pais_residencia, x.periodo,
       CAST(x.periodo + to_months(t.k) AS DATE) AS fecha_std,
       CAST(trunc(x.turistas_no_residentes / 3) AS BIGINT) AS turistas
FROM landed x JOIN (VALUES (0), (1), (2)) t(k) ON true
WHERE x.src IN {O.QUARTERLY_IN}"""))
def q_quarter_to_month(spark, d):
    """Every quarterly row becomes three monthly rows with ``int(v/3)``."""
    raw = fx.landed_arrivals(spark, d).filter(F.col("src").isin(*fx.QUARTERLY_SOURCES))
    out = calendar.expand_by_frequency(raw.withColumn("frequency", F.lit("trimestral")),
                                       "periodo", "turistas_no_residentes")
    return out.select("src", "pais_residencia", "periodo", "fecha_std",
                      F.col("turistas_no_residentes").alias("turistas"))


@query("month_key", O.with_([], """
SELECT k AS raw_key, CASE WHEN length(k) = 7 AND contains(k, '-') THEN k
                          ELSE strftime(try_cast(k AS TIMESTAMP), '%Y-%m') END AS indice_tiempo
FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m')
                  WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d')
                  ELSE o_orderpriority END AS k FROM orders)
WHERE CASE WHEN length(k) = 7 AND contains(k, '-') THEN k
           ELSE strftime(try_cast(k AS TIMESTAMP), '%Y-%m') END IS NOT NULL"""))
def q_month_key(spark, d):
    """T3 + T4: mixed period text (month keys, dates, junk; the form chosen by order status) to ``yyyy-MM``; bad keys dropped."""
    o = fx.table(spark, d, "orders")
    k = (F.when(F.col("o_orderstatus") == "F", month_key("o_orderdate"))
         .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd"))
         .otherwise(F.col("o_orderpriority")))
    return (o.select(k.alias("raw_key"))
            .withColumn("indice_tiempo", normalise_month_key("raw_key"))
            .filter(F.col("indice_tiempo").isNotNull()))


_CAL_SQL = ", ".join(
    [f"CAST(coalesce(mes = {i + 1}, false) AS INTEGER) AS es_{m}" for i, m in enumerate(O.MONTHS)]
)


@query("calendar_flags", O.with_(["fact"], f"""
SELECT indice_tiempo, "año", mes, {_CAL_SQL},
       CAST(coalesce(mes IN (2, 3), false) AS INTEGER) AS mes_vendimia,
       CAST(coalesce(mes IN (7, 8), false) AS INTEGER) AS vacaciones_invierno,
       CAST(coalesce(mes IN (1, 2, 3, 7, 8, 12), false) AS INTEGER) AS temporada_alta,
       make_date("año", mes, 1) AS fecha_mes
FROM (SELECT DISTINCT indice_tiempo, CAST(split_part(indice_tiempo, '-', 1) AS INTEGER) AS "año",
             CAST(split_part(indice_tiempo, '-', 2) AS INTEGER) AS mes FROM fact)"""))
def q_calendar_flags(spark, d):
    """Year, month, twelve dummies, three event flags and the month date, per fact month."""
    months = pl.fact(spark, d).select("indice_tiempo").distinct()
    return calendar.calendar_features(months).withColumn("fecha_mes", calendar.month_date())


@query("era_label", O.with_(["fact"], """
SELECT "año", mes, make_date("año", mes, 1) AS fecha,
       CASE WHEN "año" IN (2020, 2021) THEN 'Pandemia COVID-19'
            WHEN "año" < 2020 THEN 'Pre-Pandemia (2014-2019)' ELSE 'Post-Pandemia (2022+)' END AS periodo,
       CASE mes WHEN 1 THEN 'Enero' WHEN 2 THEN 'Febrero' WHEN 3 THEN 'Marzo' WHEN 4 THEN 'Abril'
                WHEN 5 THEN 'Mayo' WHEN 6 THEN 'Junio' WHEN 7 THEN 'Julio' WHEN 8 THEN 'Agosto'
                WHEN 9 THEN 'Septiembre' WHEN 10 THEN 'Octubre' WHEN 11 THEN 'Noviembre'
                ELSE 'Diciembre' END AS mes_nombre,
       turistas
FROM (SELECT CAST(split_part(indice_tiempo, '-', 1) AS INTEGER) AS "año",
             CAST(split_part(indice_tiempo, '-', 2) AS INTEGER) AS mes, CAST(sum(turistas) AS BIGINT) AS turistas
      FROM fact GROUP BY 1, 2)"""))
def q_era_label(spark, d):
    """A11 + T8-T10: visitors by (year, month) with month date, era and month name."""
    f = calendar.year_month(pl.fact(spark, d))
    g = f.groupBy("año", "mes").agg(F.sum("turistas").cast("long").alias("turistas"))
    return g.select("año", "mes", calendar.month_date().alias("fecha"), calendar.era().alias("periodo"),
                    calendar.month_label().alias("mes_nombre"), "turistas")


# ====================================================================== cleaning

@query("clean_text", O.with_([], f"""
SELECT n_name AS raw, {O.title("trim(n_name)")} AS pais_origen FROM nation
UNION ALL
SELECT p_type AS raw, {O.title("trim(p_type)")} FROM part
UNION ALL
SELECT c_mktsegment AS raw, {O.title("trim(c_mktsegment)")} FROM customer"""))
def q_clean_text(spark, d):
    """C8 + C9: strip and Python title case over text columns of the tables."""
    parts = [fx.table(spark, d, t).select(F.col(c).alias("raw"))
             for t, c in (("nation", "n_name"), ("part", "p_type"), ("customer", "c_mktsegment"))]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.select("raw", clean_text("raw").alias("pais_origen"))


@query("coerce_numbers", O.with_([], r"""
SELECT page_id, seg,
       CASE WHEN regexp_matches(seg, '^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$')
            THEN CAST(trim(seg) AS DOUBLE) END AS valor,
       CAST(trunc(coalesce(CASE WHEN regexp_matches(seg, '^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$')
            THEN CAST(trim(seg) AS DOUBLE) END, 0.0)) AS BIGINT) AS valor_o_cero
FROM (SELECT page_id, split_part(url, '/', 5) AS seg FROM pages)"""))
def q_coerce_numbers(spark, d):
    """C10 + C11: text to number with the strict guard ('12d', '1,2', '' -> NULL), then 0 and truncation."""
    p = fx.table(spark, d, "pages").select("page_id", F.split_part("url", F.lit("/"), F.lit(5)).alias("seg"))
    return p.select("page_id", "seg", safe_number("seg").alias("valor"), number_or_zero("seg").alias("valor_o_cero"))


@query("coerce_dates", O.with_([], """
SELECT o_orderkey, raw, CAST(raw AS TIMESTAMP) AS fecha
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'n/a' || o_orderpriority
                              WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
                              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS raw FROM orders)
WHERE try_cast(raw AS TIMESTAMP) IS NOT NULL AND CAST(raw AS TIMESTAMP) >= TIMESTAMP '1996-01-01'"""))
def q_coerce_dates(spark, d):
    """C12 + C13: text (date, ISO date-time, junk) to timestamp; bad and pre-floor rows dropped."""
    o = fx.table(spark, d, "orders")
    raw = (F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("n/a"), "o_orderpriority"))
           .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
           .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))
    x = o.select("o_orderkey", raw.alias("raw")).withColumn("fecha", parse_ts("raw"))
    return x.filter(F.col("fecha").isNotNull() & (F.col("fecha") >= F.lit("1996-01-01").cast("timestamp")))


@query("quote_filter", O.with_(["quotes_clean"], "SELECT casa, fecha, venta FROM quotes_clean"))
def q_quote_filter(spark, d):
    """C14: official house only, date inside [start, run_ts], numeric price."""
    return pl.clean_quotes(spark, d)


# Fixture rule set for C18 on documents.lang: 'es' and 'fr' merge into one class.
LANG_RULES = {"es": "es-fr", "fr": "es-fr"}


@query("map_categories", O.with_([], """
SELECT doc_id, lang, CASE WHEN trim(lang) IN ('es', 'fr') THEN 'es-fr' ELSE trim(lang) END AS lang_clean
FROM documents"""))
def q_map_categories(spark, d):
    """Strip, replace by rule, strip."""
    docs = fx.table(spark, d, "documents").select("doc_id", "lang")
    return docs.withColumn("lang_clean", clean.map_category("lang", LANG_RULES))


@query("category_report", O.with_([], """
WITH raw AS (SELECT lang AS value, count(*) AS n FROM documents GROUP BY 1),
tot AS (SELECT sum(n) AS total FROM raw),
m AS (SELECT value, n, CASE WHEN trim(value) IN ('es', 'fr') THEN 'es-fr' END AS rule_target,
             coalesce(CASE WHEN trim(value) IN ('es', 'fr') THEN 'es-fr' END, trim(value)) AS mapped FROM raw),
both_ AS (SELECT 'before' AS stage, value, n, rule_target FROM m
          UNION ALL
          SELECT 'after', mapped, CAST(sum(n) AS BIGINT), CAST(NULL AS VARCHAR) FROM m GROUP BY mapped)
SELECT stage, value, n, rule_target, round_even(n * 100.0 / (SELECT total FROM tot) * 100.0, 0) / 100.0 AS pct
FROM both_"""))
def q_category_report(spark, d):
    """Value counts and shares before and after the rules, with the rule each raw value hit."""
    return clean.category_report(fx.table(spark, d, "documents"), "lang", LANG_RULES)


# ====================================================================== assembly

@query("monthly_fact", O.with_(["fact"], "SELECT * FROM fact"))
def q_monthly_fact(spark, d):
    """A1 (+ U1, C6-C13, T1-T2): visitors by month x origin x entry point."""
    return pl.fact(spark, d)


@query("conservation", O.with_(["landed", "std", "fact"], f"""
SELECT r.total_raw, s.total_standardised, f.total_fact, r.rows_raw, s.rows_standardised, f.rows_fact,
       r.total_raw - s.total_standardised AS expansion_loss,
       s.total_standardised - f.total_fact AS aggregation_diff,
       abs(s.total_standardised - f.total_fact) <= 1 AS ok
FROM (SELECT CAST(sum(turistas_no_residentes) AS BIGINT) AS total_raw, count(*) AS rows_raw
      FROM landed WHERE periodo >= DATE '{O.P.start}') r,
     (SELECT CAST(sum(turistas) AS BIGINT) AS total_standardised, count(*) AS rows_standardised FROM std) s,
     (SELECT CAST(sum(turistas) AS BIGINT) AS total_fact, count(*) AS rows_fact FROM fact) f"""))
def q_conservation(spark, d):
    """A2: totals before expansion, after standardising and after the fact aggregate."""
    raw = pl.raw_arrivals(spark, d).filter(F.col("period") >= F.lit(pl.DEFAULT.start).cast("date"))
    std = pl.standardised(spark, d)
    return assemble.conservation(raw, std, assemble.monthly_fact(std))


# Landed arrivals as text, with countries whose numbers or dates cannot be read, and one source that the catalogue lacks.
_SPOILED_SQL = """
spoiled AS (SELECT *, pais_residencia LIKE 'A%' AS no_number, pais_residencia LIKE 'I%' AS no_date,
                   src IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AS quarterly, src <> '4-NOT SPECIFIED' AS known,
                   CASE WHEN pais_residencia LIKE 'A%' THEN 0 ELSE turistas_no_residentes END AS n FROM landed)"""


@query("run_counters", O.with_extra(["landed"], _SPOILED_SQL, """
SELECT count(*) AS rows_read, count(*) FILTER (NOT known) AS unknown_sources, count(*) FILTER (known) AS rows_of_known_sources,
       count(*) FILTER (known AND no_number) AS bad_numbers, count(*) FILTER (known AND no_date) AS bad_dates,
       count(*) FILTER (known AND NOT no_date AND periodo < DATE '1996-01-01') AS before_floor,
       CAST(sum(n) FILTER (stays) AS BIGINT) AS total_kept,
       CAST(sum(CASE WHEN quarterly THEN 3 ELSE 1 END) FILTER (stays) AS BIGINT) AS rows_out,
       CAST(sum(CASE WHEN quarterly THEN n // 3 * 3 ELSE n END) FILTER (stays) AS BIGINT) AS total_out,
       CAST(sum(CASE WHEN quarterly THEN n % 3 ELSE 0 END) FILTER (stays) AS BIGINT) AS split_loss,
       CAST(sum(CASE WHEN quarterly THEN 3 ELSE 1 END) FILTER (stays) AS BIGINT) AS rows_written,
       count(DISTINCT src) FILTER (stays) AS folders
FROM (SELECT *, known AND NOT no_date AND periodo >= DATE '1996-01-01' AS stays FROM spoiled)"""))
def q_run_counters(spark, d):
    """A2 + A20 + C5 + C10-C13 + S15: counters observed on the write of the standardised rows by source."""
    from arrivo.session import scratch_path

    raw = pl.raw_arrivals(spark, d)
    starts = lambda x: F.col("country").startswith(x)
    spoiled = raw.select("src", "country", F.when(starts("A"), "n/a").otherwise(F.col("visitors").cast("string")).alias("visitors"),
                         F.when(starts("I"), "unknown").otherwise(F.col("period").cast("string")).alias("period"))
    known = pl.fixture_catalog(spark).where("src != '4-NOT SPECIFIED'")
    watch, path = RunCounters(), scratch_path(spark, "counted")
    std = clean.standardise_arrivals(spoiled, known, "1996-01-01", watch)
    catalog.write_partitioned(std.withColumnRenamed("src", "source"), path, ("source",))
    back = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows_written"), F.count_distinct("source").alias("folders"))
    return back.withColumns({k: F.lit(v).cast("long") for k, v in watch.values().items()})


@query("quotes_monthly", O.with_(["quotes_monthly"], "SELECT * FROM quotes_monthly"))
def q_quotes_monthly(spark, d):
    """A3: monthly quote statistics."""
    return pl.quotes_monthly(spark, d)


@query("interest_monthly", O.with_(["interest_monthly"], "SELECT * FROM interest_monthly"))
def q_interest_monthly(spark, d):
    """A4 + W3: monthly interest statistics and the high-interest flag."""
    return pl.interest_monthly(spark, d)


@query("final_table", O.with_(["final"], "SELECT * FROM final"))
def q_final_table(spark, d):
    """The curated table."""
    return pl.final(spark, d)


@query("join_coverage", O.with_(["final"], """
SELECT count(*) AS rows, count(precio_promedio_usd) AS quote_matches,
       count(interes_google_promedio) AS interest_matches,
       round_even(count(precio_promedio_usd) * 100.0 / count(*) * 100.0, 0) / 100.0 AS quote_pct,
       round_even(count(interes_google_promedio) * 100.0 / count(*) * 100.0, 0) / 100.0 AS interest_pct
FROM final"""))
def q_join_coverage(spark, d):
    """Share of rows matched by each side series."""
    return assemble.join_coverage(pl.final(spark, d))


@query("missing_side", O.with_(["fact"], """
SELECT indice_tiempo, pais_origen, punto_entrada, turistas,
       CAST(NULL AS DOUBLE) AS precio_promedio_usd, CAST(NULL AS INTEGER) AS usd_alto
FROM fact"""))
def q_missing_side(spark, d):
    """A missing quote table still yields the full schema with typed NULLs."""
    j = assemble.join_quotes(pl.fact(spark, d), None)
    return j.select(*assemble.KEYS, "turistas", "precio_promedio_usd", "usd_alto")
