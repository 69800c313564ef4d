"""Final-table assembly: fact aggregate, side tables, joins, median flags, rank.

Plan shape at any scale: the only data-sized work is the fact aggregate (a
partial + final hash aggregate over the arrival rows) and the two monthly side
aggregates.  Their outputs are bounded by months x origins x points and by
months, so every later join is against a small side: AQE turns those joins
into broadcasts from the measured stage size (no hint on data whose size is not
proven).  Medians that decide the flags are taken on month tables (bounded
by the calendar), so the whole final table is one query plan in which the
fact aggregate runs once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivo.functions import mean_of, month_key, rint_round
from arrivo.operators.calendar import calendar_features
from arrivo.operators.ranks import LIMIT, quantiles, rank_by_ranges

KEYS = ["indice_tiempo", "pais_origen", "punto_entrada"]

QUOTE_COLUMNS = ["precio_promedio_usd", "precio_minimo_usd", "precio_maximo_usd", "dias",
                 "variacion_usd_mensual", "variacion_porcentual_usd"]
QUOTES_MONTHLY_SCHEMA = T.StructType(
    [T.StructField("indice_tiempo", T.StringType())]
    + [T.StructField(c, T.LongType() if c == "dias" else T.DoubleType()) for c in QUOTE_COLUMNS]
)
INTEREST_MONTHLY_SCHEMA = T.StructType([
    T.StructField("indice_tiempo", T.StringType()),
    T.StructField("interes_google_promedio", T.DoubleType()),
    T.StructField("interes_google_max", T.DoubleType()),
    T.StructField("interes_google_min", T.DoubleType()),
    T.StructField("registros", T.LongType()),
    T.StructField("interes_alto", T.IntegerType()),
])


# ---------------------------------------------------------------- U1, A1, A2

def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Concatenate by column name (missing columns become NULL)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def monthly_fact(std: DataFrame, with_mean: bool = False) -> DataFrame:
    """A1: visitors summed by month, origin and entry point (D9: optional mean beside the sum)."""
    aggs = [F.sum("turistas").cast("long").alias("turistas")]
    if with_mean:
        aggs.append(F.avg("turistas").alias("turistas_promedio"))
    return std.groupBy(*KEYS).agg(*aggs)


def conservation(raw: DataFrame, std: DataFrame, fact: DataFrame, raw_value: str = "visitors",
                 tolerance: int = 1) -> DataFrame:
    """A2: totals before and after each step, in one row.

    ``expansion_loss`` is what truncation in the quarter split drops (quirk Q1);
    ``aggregation_diff`` must stay within ``tolerance`` (the reference's check).
    """
    stages = [("raw", raw, raw_value), ("standardised", std, "turistas"), ("fact", fact, "turistas")]
    parts = [d.agg(F.sum(F.col(v).cast("long")).alias("total"), F.count(F.lit(1)).alias("rows"))
             .withColumn("stage", F.lit(name)) for name, d, v in stages]
    # one plan: the three aggregates share the landed-arrivals stage, which is computed once and reused
    u = reduce(lambda a, b: a.unionByName(b), parts)
    w = u.groupBy().pivot("stage", [n for n, _, _ in stages]).agg(F.first("total").alias("total"),
                                                                   F.first("rows").alias("rows"))
    t_raw, t_std, t_fact = F.col("raw_total"), F.col("standardised_total"), F.col("fact_total")
    return w.select(
        t_raw.alias("total_raw"), t_std.alias("total_standardised"), t_fact.alias("total_fact"),
        F.col("raw_rows").alias("rows_raw"), F.col("standardised_rows").alias("rows_standardised"),
        F.col("fact_rows").alias("rows_fact"),
        (t_raw - t_std).alias("expansion_loss"),
        (t_std - t_fact).alias("aggregation_diff"),
        (F.abs(t_std - t_fact) <= F.lit(tolerance)).alias("ok"),
    )


# ---------------------------------------------------------------- A3, A4, W3

def quotes_monthly(clean_q: DataFrame) -> DataFrame:
    """A3: monthly mean/min/max/count of the quote, spread and percent spread, rounded half-even to 2.

    The mean is rounded to 12 significant digits, so it does not depend on row order.
    A zero minimum gives a NULL percent (no error).
    """
    g = clean_q.groupBy(month_key("fecha").alias("indice_tiempo")).agg(
        mean_of("venta").alias("_mean"),
        F.min("venta").alias("_min"),
        F.max("venta").alias("_max"),
        F.count("venta").alias("dias"),
    )
    return g.select(
        "indice_tiempo",
        rint_round("_mean", 2).alias("precio_promedio_usd"),
        rint_round("_min", 2).alias("precio_minimo_usd"),
        rint_round("_max", 2).alias("precio_maximo_usd"),
        "dias",
        rint_round(F.col("_max") - F.col("_min"), 2).alias("variacion_usd_mensual"),
        rint_round(F.try_divide(F.col("_max") - F.col("_min"), F.col("_min")) * F.lit(100.0), 2)
        .alias("variacion_porcentual_usd"),
    )


def median_flag(df: DataFrame, value: str, name: str, median_of: DataFrame | None = None,
                require_match: bool = True) -> DataFrame:
    """``name`` = value > median(value) as 0/1; NULL value gives 0.

    The median is an exact (interpolated) rank selection used as a scalar subquery:
    computed once, then compared on every row in the same projection.  Never a
    window over the whole table, which would run in one task.  With
    ``require_match`` the flag is NULL when no row has a value (the reference
    adds no column then; we keep the schema, quirk Q8).
    """
    src = median_of if median_of is not None else df
    med = quantiles(src, [], value, [0.5]).select(F.element_at("q", 1)).scalar()
    flag = F.coalesce((F.col(value) > med).cast("int"), F.lit(0))
    if require_match:
        flag = F.when(src.agg(F.count(F.col(value))).scalar() > 0, flag)
    return df.withColumn(name, flag)


def month_median(value, weight=None):
    """Median over a table keyed by month, as a window over the whole (small) table.

    A month table has one row per calendar month (a few hundred rows for
    decades), so the single partition this window runs in is bounded by the
    calendar, not by the data.  Never used on row-level tables.
    """
    w = Window.partitionBy()
    p = F.percentile(F.col(value), F.lit(0.5), weight) if weight is not None else F.percentile(F.col(value), F.lit(0.5))
    return p.over(w)


def interest_monthly(clean_i: DataFrame) -> DataFrame:
    """A4 + W3: monthly mean (rounded to 1), max, min, count; high-interest flag vs the median over months."""
    g = clean_i.groupBy(month_key("fecha").alias("indice_tiempo")).agg(
        rint_round(mean_of("interes_google"), 1).alias("interes_google_promedio"),
        F.max("interes_google").alias("interes_google_max"),
        F.min("interes_google").alias("interes_google_min"),
        F.count("interes_google").alias("registros"),
    )
    flag = F.coalesce((F.col("interes_google_promedio") > month_median("interes_google_promedio")).cast("int"), F.lit(0))
    return g.withColumn("interes_alto", flag)


# ---------------------------------------------------------------- J1-J4, W1, W2, final

def empty_like(spark, schema: T.StructType) -> DataFrame:
    """An empty typed table; joining it gives typed NULL columns."""
    return spark.createDataFrame([], schema)


def join_quotes(fact: DataFrame, qm: DataFrame | None) -> DataFrame:
    """J1 + W1 + W2: left join the monthly quotes, flag price and spread above their median over joined rows.

    The median over joined rows is row-weighted: a month's price counts once
    per fact row of that month.  So it is taken on the month table with the
    fact's row count per month as the frequency (``percentile(v, 0.5, n)``),
    which gives the same value without a second pass over the rows and
    without a whole-table window.  The fact is referenced twice in one plan;
    its aggregate stage is computed once and reused.  When no quote table
    exists (J4) the columns are typed NULLs; when quotes exist but no month
    matches, the flags are 0.
    """
    if qm is None:
        j = fact.join(empty_like(fact.sparkSession, QUOTES_MONTHLY_SCHEMA), "indice_tiempo", "left")
        return j.withColumns({"usd_alto": F.lit(None).cast("int"), "usd_alta_variabilidad": F.lit(None).cast("int")})
    # count(turistas) (never NULL, so the row count) keeps this branch's columns equal to the main
    # branch's, so both read the same fact stage: its exchange is reused, the arrival join runs once
    rows = fact.groupBy("indice_tiempo").agg(F.count("turistas").alias("_rows"))
    q = qm.select("indice_tiempo", *QUOTE_COLUMNS).join(rows, "indice_tiempo")
    q = q.withColumns({
        "_m_price": month_median("precio_promedio_usd", F.col("_rows")),
        "_m_spread": month_median("variacion_usd_mensual", F.col("_rows")),
    })
    q = q.withColumns({
        "usd_alto": F.coalesce((F.col("precio_promedio_usd") > F.col("_m_price")).cast("int"), F.lit(0)),
        "usd_alta_variabilidad": F.coalesce((F.col("variacion_usd_mensual") > F.col("_m_spread")).cast("int"), F.lit(0)),
    }).drop("_rows", "_m_price", "_m_spread")
    j = fact.join(q, "indice_tiempo", "left")
    return j.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("usd_alto", "usd_alta_variabilidad")})


def join_interest(df: DataFrame, im: DataFrame | None) -> DataFrame:
    """J2 (+ W4 when the monthly table has no flag): left join the interest mean and flag."""
    if im is None:
        im = empty_like(df.sparkSession, INTEREST_MONTHLY_SCHEMA)
    cols = ["indice_tiempo", "interes_google_promedio"] + (["interes_alto"] if "interes_alto" in im.columns else [])
    out = df.join(im.select(*cols), "indice_tiempo", "left")
    if "interes_alto" not in im.columns:
        out = median_flag(out, "interes_google_promedio", "interes_alto", require_match=False)
    return out


FINAL_ORDER = (
    KEYS + ["turistas"] + QUOTE_COLUMNS + ["usd_alto", "usd_alta_variabilidad", "interes_google_promedio", "interes_alto"]
)


def final_table(fact: DataFrame, qm: DataFrame | None, im: DataFrame | None) -> DataFrame:
    """The curated month x origin x entry-point table with side series, flags and calendar features."""
    out = calendar_features(join_interest(join_quotes(fact, qm), im))
    cal = [c for c in out.columns if c not in FINAL_ORDER]
    return out.select(*[F.col(f"`{c}`") for c in FINAL_ORDER + cal])


def join_coverage(df: DataFrame) -> DataFrame:
    """Matched rows over all rows for each side series (one aggregate)."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("precio_promedio_usd").alias("quote_matches"),
        F.count("interes_google_promedio").alias("interest_matches"),
    ).select(
        "rows", "quote_matches", "interest_matches",
        rint_round(F.try_divide(F.col("quote_matches") * F.lit(100.0), F.col("rows").cast("double")), 2).alias("quote_pct"),
        rint_round(F.try_divide(F.col("interest_matches") * F.lit(100.0), F.col("rows").cast("double")), 2).alias("interest_pct"),
    )


# ---------------------------------------------------------------- W5

def positional_rank(df: DataFrame, keys=KEYS, name: str = "pos", limit: int = LIMIT) -> DataFrame:
    """1-based global row number in key order, without a single-partition window over the rows.

    The first key (the month) splits the work: each month's rows are numbered
    by ``row_number`` inside that month (one task per month), and each month gets the offset of
    all earlier months from a cumulative sum over the per-month count table,
    which has one row per month (a missing month is one, ordered first).
    Where a month holds more than ``limit`` rows, the rows are ranked by ranges of
    all keys instead (``ranks.rank_by_ranges``), which cut a hot month as well.
    Counts the months when called.  Rows with equal keys get their numbers in any order.
    """
    first, rest = keys[0], list(keys[1:])
    per = df.groupBy(F.col(f"`{first}`").alias("_first")).agg(F.count(F.lit(1)).alias("_n"))
    largest, rows = per.agg(F.max("_n"), F.sum("_n")).first()
    if (largest or 0) > limit:
        return rank_by_ranges(df, list(keys), name, rows, limit)
    offsets = per.select(
        "_first",
        F.coalesce(F.sum("_n").over(Window.orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("_off"),
    )
    w = Window.partitionBy(f"`{first}`").orderBy(*[F.col(f"`{k}`") for k in rest])
    return (
        df.withColumn("_local", F.row_number().over(w))
        .join(offsets, F.col(f"`{first}`").eqNullSafe(F.col("_first")))
        .withColumn(name, (F.col("_off") + F.col("_local")).cast("long"))
        .drop("_local", "_off", "_first")
    )
