"""Landing validation and run reports (S13, S14, Q-13 to Q-18, A18).

A landed file is described by a manifest row (path, size, status, category).
Per-file content checks are one aggregate per table, all unioned into one
plan; the roll-ups over files are small grouped aggregates.  Row counts and
empty-column counts hold for the whole table, and decide.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivo.functions import rint_round
from arrivo.sources.catalog import DEFAULTS, header_status, landing_status

# Categories, critical ones, and column keywords per category.
CATEGORIES = ["turismo", "economico", "infraestructura", "general", "trends"]
CRITICAL = ["turismo", "economico"]
TOURISM_KEYWORDS = ["turista", "visitante", "pernoctacion", "ocupacion"]
MIN_ROWS = DEFAULTS["min_rows_per_table"]
READY_RATE, READY_MAX_ISSUES = 70.0, 5
ADVICE = [
    ("rate_below_80", "Mejorar robustez de descarga de datos"),
    ("issues_over_3", "Implementar validaciones más estrictas"),
    ("no_economic", "Priorizar incorporación de variables económicas"),
]


#: Rows that are looked at first, to see which columns hold a value.
PROBE_ROWS = 1000


def unproven_columns(df: DataFrame, rows: int = PROBE_ROWS) -> list[str]:
    """Columns without a value among the first ``rows`` rows: only these can be empty (one short job, first partitions only)."""
    held = [F.col(f"`{c}`").isNotNull() for c in df.columns]
    seen = df.select(F.array(*held).alias("held")).take(rows) if held else []
    return [c for k, c in enumerate(df.columns) if not any(r.held[k] for r in seen)]


def table_profile(name: str, df: DataFrame, keywords=TOURISM_KEYWORDS) -> DataFrame:
    """One row of content checks for a landed table: rows, columns, empty, numeric and keyword columns.

    A value in the first rows proves that a column is not empty, so the whole table is read for the other columns only;
    if there is none, rows are counted from the files' footers. Counting every column from footers (aggregate push-down)
    would not be exact: it miscounts columns that follow a nested one, and fails where part files differ in their columns.
    """
    fields = df.schema.fields
    numeric = sum(isinstance(f.dataType, T.NumericType) for f in fields)
    keyword = sum(any(k in f.name.lower() for k in keywords) for f in fields)
    empty = reduce(lambda a, b: a + b, [(F.count(F.col(f"`{c}`")) == 0).cast("int") for c in unproven_columns(df)], F.lit(0))
    names = F.array(*[F.lit(f.name) for f in fields])
    return df.agg(F.count(F.lit(1)).alias("rows"), empty.alias("empty_columns")).select(
        F.lit(name).alias("name"), "rows", F.lit(len(fields)).alias("columns"), "empty_columns",
        F.lit(numeric).alias("numeric_columns"), F.lit(keyword).alias("keyword_columns"), names.alias("column_names"))


def file_checks(files: DataFrame, tables: dict[str, DataFrame], categories: dict[str, str],
                min_bytes: int = DEFAULTS["min_bytes"], min_rows: int = MIN_ROWS,
                header_words=TOURISM_KEYWORDS) -> DataFrame:
    """S5 + S6 + S7 + S13 + Q-13 + Q-14: one validation row per landed table.

    ``files`` is as from ``catalog.file_sizes`` (one row per table, whatever its
    number of part files); ``tables`` maps a table's name to its DataFrame;
    ``categories`` maps it to a category.  Status: ``cached`` when at least ``min_bytes`` long (already
    landed), else ``downloaded_small`` if the small-file rule (S6) takes it, else
    ``error``; the header check (S13) marks tables with no expected word, small ones first.
    """
    with ThreadPoolExecutor(8) as pool:  # the first rows of several tables at a time
        profiles = list(pool.map(lambda t: table_profile(*t), tables.items()))
    prof = reduce(lambda a, b: a.unionByName(b), [p.withColumn("category", F.lit(categories.get(n, "general")))
                                                  for n, p in zip(tables, profiles)])
    j = files.join(prof, "name")
    small = F.col("size") < F.lit(min_bytes)
    status = landing_status(F.col("size"), F.col("rows"), F.col("columns"), F.lit(min_bytes))
    enough = F.col("rows") >= F.lit(min_rows)
    return j.select(
        "name", "path", "category", "size", "files",
        rint_round(F.col("size") / F.lit(1024.0 * 1024.0), 3).alias("size_mb"),
        status.alias("status"),
        header_status(F.col("column_names"), header_words, small).alias("header_status"),
        "rows", "columns", "empty_columns", "numeric_columns",
        "keyword_columns", enough.alias("has_data"),
        F.when(enough, F.lit("good")).otherwise(F.lit("needs_review")).alias("data_quality"),
    )


def ok_status(c="status"):
    """S14 / C6 with quirk Q4 fixed: ``downloaded*`` and ``cached`` both count as success."""
    s = F.col(c)
    return s.startswith("downloaded") | (s == F.lit("cached"))


def category_rollup(checks: DataFrame, categories=CATEGORIES) -> DataFrame:
    """Q-16 + A18: files per category; ``ok`` if any succeeded, ``failed`` if none, ``unknown`` with no file."""
    spark = checks.sparkSession
    allc = spark.createDataFrame([(c,) for c in categories], "category string")
    g = checks.groupBy("category").agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(ok_status()).alias("processed"),
        F.count_if(~ok_status()).alias("skipped"),
        F.sum("rows").cast("long").alias("rows"),
    )
    out = allc.join(g, "category", "full")
    return out.select(
        "category",
        F.coalesce("files", F.lit(0)).alias("files"),
        F.coalesce("processed", F.lit(0)).alias("processed"),
        F.coalesce("skipped", F.lit(0)).alias("skipped"),
        F.coalesce("rows", F.lit(0)).cast("long").alias("rows"),
        F.when(F.col("processed") > 0, F.lit("ok")).when(F.col("files") > 0, F.lit("failed"))
        .otherwise(F.lit("unknown")).alias("status"),
    )


def issues(checks: DataFrame, min_rows: int = MIN_ROWS, critical=CRITICAL) -> DataFrame:
    """Q-15: the issue list as rows ``(name, issue)``: no numeric columns (economic), too few rows, missing critical category."""
    spark = checks.sparkSession
    ok = checks.filter(ok_status())
    no_num = ok.filter((F.col("category") == "economico") & (F.col("numeric_columns") == 0)).select(
        "name", F.lit("sin columnas numericas").alias("issue"))
    few = ok.filter(F.col("rows") < F.lit(min_rows)).select(
        "name", F.concat(F.lit("solo "), F.col("rows").cast("string"), F.lit(f" filas (minimo {min_rows})")).alias("issue"))
    crit = spark.createDataFrame([(c,) for c in critical], "category string")
    present = checks.select("category").distinct()
    missing = crit.join(present, "category", "left_anti").select(
        F.col("category").alias("name"), F.lit("categoria critica faltante").alias("issue"))
    return no_num.unionByName(few).unionByName(missing)


def readiness(checks: DataFrame, issue_rows: DataFrame, critical=CRITICAL) -> DataFrame:
    """Q-17: success rate (round 1), tourism/economic data present, and the overall readiness flag."""
    g = checks.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(ok_status()).alias("successful_files"),
        F.count_if(F.col("category") == "turismo").alias("_tur"),
        F.count_if(F.col("category") == "economico").alias("_eco"),
        F.count_distinct(F.when(F.col("category").isin(*critical), F.col("category"))).alias("_crit"),
    )
    n_issues = issue_rows.agg(F.count(F.lit(1))).scalar()
    rate = F.coalesce(rint_round(F.try_divide(F.col("successful_files") * F.lit(100.0), F.col("total_files")), 1), F.lit(0.0))
    return g.select(
        "total_files", "successful_files",
        (F.col("total_files") - F.col("successful_files")).alias("failed_files"),
        rate.alias("success_rate"),
        (F.col("_tur") > 0).alias("has_tourism_data"),
        (F.col("_eco") > 0).alias("has_economic_data"),
        n_issues.alias("quality_issues"),
        ((rate >= F.lit(READY_RATE)) & (F.col("_crit") == F.lit(len(critical))) & (n_issues < F.lit(READY_MAX_ISSUES)))
        .alias("overall_ready"),
    )


def run_report(ready: DataFrame, rollup: DataFrame, run_date: str, sources_configured: int) -> DataFrame:
    """Q-18: one-row run report: execution, acquisition summary, categories, and advice rules."""
    cats = rollup.filter(F.col("processed") > 0).agg(F.sort_array(F.collect_list("category")).alias("categorias"),
                                                     F.sum("processed").cast("long").alias("procesados"))
    advice = F.array_compact(F.array(
        F.when(F.col("success_rate") < 80, F.lit(ADVICE[0][1])),
        F.when(F.col("quality_issues") > 3, F.lit(ADVICE[1][1])),
        F.when(~F.col("has_economic_data"), F.lit(ADVICE[2][1])),
    ))
    return ready.select(
        F.lit(run_date).alias("run_date"), F.lit("completed").alias("status"),
        F.lit(sources_configured).alias("sources_configured"),
        F.struct("total_files", "successful_files", "failed_files", "success_rate").alias("acquisition"),
        F.struct("has_tourism_data", "has_economic_data", "overall_ready").alias("readiness"),
        cats.select("categorias").scalar().alias("categories_processed"),
        F.coalesce(cats.select("procesados").scalar(), F.lit(0)).alias("total_processed_files"),
        "quality_issues",
        advice.alias("recommendations"),
    )
