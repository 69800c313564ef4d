"""Driver queries for source shaping: roles by name, unions, skipped sources, category rules, readers (C3-C5, C16, C18,
C19, C24, C26, D7, Q-10, S1, S3, U1, W4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from arrivo.operators import assemble, clean
from arrivo.plans import oracle as O
from arrivo.plans import pipeline as pl
from arrivo.plans.queries import query
from arrivo.session import scratch_path
from arrivo.sources import catalog
from arrivo.sources import fixtures as fx

# Column names of the raw sources in these queries: (period, visitors, country); the fourth lacks its visitors.
SOURCE_COLUMNS = {
    "1-URGENT": ("Trimestre", "turistas", "Pais"),
    "2-HIGH": ("anio_trimestre", "turistas_no_residentes", "pais_de_residencia"),
    "3-MEDIUM": ("PERIODO", "Visitantes_total", "country"),
    "4-NOT SPECIFIED": ("periodo", "cantidad", "residencia"),
    "5-LOW": ("fecha_desde", "no_residentes", "pais_residencia"),
}
ABSENT = "4-NOT SPECIFIED"


def _sources(spark, d):
    """The landed arrivals as one table per source, each with its own column names and a column of its own."""
    landed = fx.landed_arrivals(spark, d)
    return {src: landed.filter(F.col("src") == src).select(
        "src", F.col("periodo").alias(p), F.col("turistas_no_residentes").alias(v), F.col("pais_residencia").alias(c),
        F.lit(k).alias(f"extra_{k}")) for k, (src, (p, v, c)) in enumerate(SOURCE_COLUMNS.items())}


@query("source_union", O.with_(["std"], f"""
SELECT indice_tiempo, pais_origen, punto_entrada, CAST(sum(turistas) AS BIGINT) AS turistas
FROM std WHERE src <> '{ABSENT}' GROUP BY 1, 2, 3"""))
def q_source_union(spark, d):
    """U1 + C1-C3 + C5 + C7: five tables with different column names, one without its visitors, to one monthly fact."""
    raw, _ = clean.union_by_roles(_sources(spark, d))
    std = clean.standardise_arrivals(raw, pl.fixture_catalog(spark), pl.DEFAULT.start)
    return assemble.monthly_fact(std)


@query("skipped_sources", "SELECT * FROM (VALUES " + ", ".join(
    f"('{s}', {str(s == ABSENT).lower()}, '{'visitors' if s == ABSENT else ''}')" for s in SOURCE_COLUMNS)
    + ") t(src, omitida, columnas_faltantes) WHERE src IN (SELECT DISTINCT o_orderpriority FROM orders)")
def q_skipped_sources(spark, d):
    """C5 + D7: per source, whether it was skipped and which required columns it lacks."""
    missing = {s: clean.resolve_roles(df.columns)[1] for s, df in _sources(spark, d).items()}
    rows = spark.createDataFrame([(s, bool(m), ",".join(m)) for s, m in missing.items()], "src string, omitida boolean, columnas_faltantes string")
    present = fx.landed_arrivals(spark, d).select("src").distinct()
    return rows.join(present, "src", "left_semi")


@query("last_match_role", O.with_([], "SELECT count(*) AS filas, CAST(sum(l_orderkey) AS BIGINT) AS turistas FROM lineitem"))
def q_last_match_role(spark, d):
    """Of two columns that match a role, the policy ``last`` takes the later one."""
    raw = fx.table(spark, d, "lineitem").select(F.col("l_linenumber").alias("turistas_previos"), F.col("l_orderkey").alias("turistas_finales"))
    role = clean.Role("visitors", keywords=("turistas",), policy="last")
    return clean.to_roles(raw, (role,)).agg(F.count(F.lit(1)).alias("filas"), F.sum("visitors").alias("turistas"))


@query("quote_names", O.with_(["quotes_monthly"], "SELECT indice_tiempo, precio_promedio_usd, dias FROM quotes_monthly"))
def q_quote_names(spark, d):
    """C4: a quote feed with other (listed) column names gives the same monthly quotes."""
    feed = fx.table(spark, d, "orders").select(F.col("o_orderstatus").alias("casa"), F.col("o_orderdate").alias("Fecha_Cotizacion"),
                                               F.col("o_totalprice").alias("Price"), F.col("o_custkey").alias("precio_id"))
    shaped = clean.to_roles(feed, clean.QUOTE_ROLES, keep=("casa",))
    p = pl.DEFAULT
    monthly = assemble.quotes_monthly(clean.clean_quotes(shaped, p.house_word, p.start, p.run_ts))
    return monthly.select("indice_tiempo", "precio_promedio_usd", "dias")


@query("interest_shaped", O.with_(["interest_monthly"], "SELECT indice_tiempo, interes_google_promedio, registros FROM interest_monthly"))
def q_interest_shaped(spark, d):
    """C16 + C4: the search feed as its service delivers it (``date``, the term, ``isPartial``)."""
    feed = fx.interest(spark, d).select(F.col("fecha").alias("date"), F.col("interes_google").alias("Mendoza"), F.lit(False).alias("isPartial"))
    shaped = clean.to_roles(clean.shape_interest(feed, "Mendoza"), clean.INTEREST_ROLES)
    monthly = assemble.interest_monthly(clean.clean_interest(shaped, pl.DEFAULT.start))
    return monthly.select("indice_tiempo", "interes_google_promedio", "registros")


def _spellings(rules: dict) -> list[str]:
    """Raw spellings by nation key: the rules' keys with padding, and one value that no rule has."""
    return [*rules, "Otro Pais"]


def _rules_sql(rules: dict) -> str:
    values = ", ".join(f"('{k.strip()}', '{v}')" for k, v in {k.strip(): v for k, v in reversed(rules.items())}.items())
    raw = ", ".join(f"'{k}'" for k in _spellings(rules))
    return f"""rules(k, v) AS (VALUES {values}),
raw AS (SELECT [{raw}][c_custkey % {len(_spellings(rules))} + 1] AS value FROM customer),
counted AS (SELECT value, count(*) AS n, any_value(v) AS target, trim(coalesce(any_value(v), trim(value))) AS mapped
            FROM raw LEFT JOIN rules ON trim(value) = k GROUP BY value)"""


def _raw_values(spark, d, rules):
    names = F.array(*[F.lit(x) for x in _spellings(rules)])
    return fx.table(spark, d, "customer").select(
        F.element_at(names, (F.col("c_custkey") % len(_spellings(rules)) + 1).cast("int")).alias("value"))


@query("origin_rules", f"""WITH {_rules_sql(clean.ORIGIN_RULES)}
SELECT stage, value, CAST(n AS BIGINT) AS n, rule_target, {O.rnd("n / (SELECT sum(n) FROM counted) * 100.0")} AS pct FROM (
  SELECT 'before' AS stage, value, n, target AS rule_target FROM counted
  UNION ALL SELECT 'after', mapped, sum(n), NULL FROM counted GROUP BY mapped)""")
def q_origin_rules(spark, d):
    """C18 + C19: all origin rules on raw spellings, counts before and after."""
    return clean.category_report(_raw_values(spark, d, clean.ORIGIN_RULES), "value", clean.ORIGIN_RULES)


@query("point_rules", f"""WITH {_rules_sql(clean.POINT_RULES)}
SELECT count(*) AS categories_before, count(DISTINCT mapped) AS categories_after, count(target) AS rules_hit,
       CAST(coalesce(sum(n) FILTER (target IS NOT NULL), 0) AS BIGINT) AS rows_affected, CAST(sum(n) AS BIGINT) AS rows,
       count(*) - count(DISTINCT mapped) AS categories_merged FROM counted""")
def q_point_rules(spark, d):
    """C18 + C19 totals: the entry-point rules on raw spellings."""
    return clean.category_summary(_raw_values(spark, d, clean.POINT_RULES), "value", clean.POINT_RULES)


@query("model_columns", O.with_(["final"], """
SELECT precio_promedio_usd, mes, pais_origen, punto_entrada, turistas FROM final WHERE turistas > 0"""))
def q_model_columns(spark, d):
    """C24 + C21: the columns a model expects, in order, then the target."""
    return clean.features_and_target(clean.drop_zero_target(pl.curated(spark, d)), ["precio_promedio_usd", "mes", "pais_origen", "punto_entrada"])


@query("scatter_rows", O.with_(["final"], """
SELECT interes_google_promedio, turistas, pais_origen FROM final WHERE interes_google_promedio IS NOT NULL AND turistas IS NOT NULL"""))
def q_scatter_rows(spark, d):
    """The (interest, visitors) pairs behind the scatter plot."""
    return clean.scatter_rows(pl.curated(spark, d), "interes_google_promedio", "turistas", "pais_origen")


@query("zero_examples", O.with_(["final"], """
SELECT indice_tiempo, pais_origen, punto_entrada, turistas FROM final WHERE turistas = 0
ORDER BY indice_tiempo, pais_origen, punto_entrada LIMIT 5"""))
def q_zero_examples(spark, d):
    """Q-10: five example rows with a zero target (a report's feature, in key order)."""
    keys = ["indice_tiempo", "pais_origen", "punto_entrada"]
    return pl.curated(spark, d).filter("turistas = 0").orderBy(*keys).limit(5).select(*keys, "turistas")


@query("csv_comma_roundtrip", O.with_(["quotes_monthly"], "SELECT indice_tiempo, precio_promedio_usd, dias FROM quotes_monthly"))
def q_csv_comma_roundtrip(spark, d):
    """The monthly quotes as comma CSV, read back with their schema."""
    df = pl.quotes_monthly(spark, d).select("indice_tiempo", "precio_promedio_usd", "dias")
    path = scratch_path(spark, "comma")
    catalog.write_sorted(df, path, keys=("indice_tiempo",), fmt="csv", sep=",")
    return catalog.read_csv(spark, path, schema=df.schema, sep=",")


@query("json_list_roundtrip", O.with_(["quotes_monthly"], "SELECT indice_tiempo, precio_promedio_usd, dias FROM quotes_monthly"))
def q_json_list_roundtrip(spark, d):
    """S3: JSON documents holding a list of records each, one document and file per year, read back as rows.

    Written by year, since the multi-line reader takes one document per file.
    """
    df = pl.quotes_monthly(spark, d).select("indice_tiempo", "precio_promedio_usd", "dias")
    path = scratch_path(spark, "list")
    lists = df.groupBy(F.substring("indice_tiempo", 1, 4).alias("year")).agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value"))
    lists.write.partitionBy("year").text(path)
    return catalog.read_json(spark, path, schema=df.schema).select(*df.columns)


@query("flags_without_quotes", O.with_(["fact"], """
SELECT indice_tiempo, pais_origen, punto_entrada, CAST(NULL AS INTEGER) AS usd_alto FROM fact"""))
def q_flags_without_quotes(spark, d):
    """With no quote at all the median flag is NULL, and the column stays."""
    fact = pl.fact(spark, d).withColumn("precio_promedio_usd", F.lit(None).cast("double"))
    return assemble.median_flag(fact, "precio_promedio_usd", "usd_alto").select("indice_tiempo", "pais_origen", "punto_entrada", "usd_alto")


@query("flags_on_rows", O.with_(["final"], """
SELECT indice_tiempo, pais_origen, punto_entrada, CAST(CASE WHEN m IS NULL THEN NULL ELSE coalesce(CAST(interes_google_promedio > m AS INTEGER), 0) END
       AS INTEGER) AS interes_alto_filas FROM final, (SELECT quantile_cont(interes_google_promedio, 0.5) AS m FROM final)"""))
def q_flags_on_rows(spark, d):
    """Where the side table has no flag, the flag comes from the median over the joined rows."""
    rows = pl.curated(spark, d)
    return assemble.median_flag(rows, "interes_google_promedio", "interes_alto_filas").select(
        "indice_tiempo", "pais_origen", "punto_entrada", "interes_alto_filas")


@query("first_available", O.with_(["quotes_monthly"], "SELECT indice_tiempo, precio_promedio_usd, dias FROM quotes_monthly"))
def q_first_available(spark, d):
    """The full table is not there, so the sample under the next path is read."""
    df = pl.quotes_monthly(spark, d).select("indice_tiempo", "precio_promedio_usd", "dias")
    path = scratch_path(spark, "sample")
    df.write.parquet(path)
    return catalog.read_first(spark, [f"{path}-full", path])
