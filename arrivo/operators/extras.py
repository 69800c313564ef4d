"""Operations the reference declares in its configuration but never runs.

Where the configuration leaves an edge open (seasonal method, class edges,
the recent-data window) the choice is ours and stated in the docstring.
Lags and day-over-day changes are gap-safe self-joins on shifted keys: the
join key includes the month (or day), so a series holding a third of all rows
is still spread over many tasks, unlike a window partitioned by the series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivo.functions import mean_of, month_key, rint_round
from arrivo.operators.ranks import quantiles

# Class labels and thresholds from the reference configuration.
PRICE_CLASSES = ["bajo", "medio", "alto", "muy_alto"]
DEMAND_CLASSES = ["muy_bajo", "bajo", "medio", "alto", "muy_alto"]
VOLATILITY_THRESHOLD = 5.0
PRICE_MIN, PRICE_MAX, MAX_DAILY_CHANGE = 10.0, 3000.0, 50.0
LAGS = (1, 12)


def quote_volatility(clean_q: DataFrame, threshold: float = VOLATILITY_THRESHOLD) -> DataFrame:
    """Monthly std of the quote, volatility = std / mean x 100, and its class at the threshold."""
    g = clean_q.groupBy(month_key("fecha").alias("indice_tiempo")).agg(
        mean_of("venta").alias("_m"), F.stddev_samp("venta").alias("_s"), F.count("venta").alias("dias"))
    vol = rint_round(F.try_divide(F.col("_s"), F.col("_m")) * F.lit(100.0), 4)
    return g.select(
        "indice_tiempo", "dias", rint_round("_s", 4).alias("precio_std"), vol.alias("volatilidad_pct"),
        F.when(vol > F.lit(threshold), F.lit("volatil")).otherwise(F.lit("estable")).alias("periodo"),
    )


def lags(fact: DataFrame, keys=("pais_origen", "punto_entrada"), month: str = "indice_tiempo",
         value: str = "turistas", periods=LAGS) -> DataFrame:
    """Value 1 and 12 months earlier in the same series, and the growth against each (percent).

    A missing month gives NULL (gap-safe): each lag is an equi-join of the
    series with itself shifted by ``p`` months on (series keys, month).
    """
    base = fact.select(*keys, month, value)
    out = base
    for p in periods:
        shifted = base.select(*keys, F.date_format(F.add_months(F.to_date(F.concat(F.col(month), F.lit("-01"))), p),
                                                   "yyyy-MM").alias(month),
                              F.col(value).alias(f"lag_{p}"))
        out = out.join(shifted, [*keys, month], "left")
    for p in periods:
        out = out.withColumn(f"crecimiento_{p}",
                             rint_round(F.try_divide((F.col(value) - F.col(f"lag_{p}")).cast("double"),
                                                     F.col(f"lag_{p}").cast("double")) * F.lit(100.0), 4))
    return out


def seasonal_ratio(df: DataFrame, keys=("pais_origen", "punto_entrada"), month: str = "mes", value: str = "turistas") -> DataFrame:
    """D3 (method ours): value over the mean of the same calendar month in the same series.

    The mean per (series, calendar month) is an aggregate joined back on its
    keys (bounded by series x 12), not a window over the rows.
    """
    m = df.groupBy(*keys, month).agg(F.avg(F.col(value).cast("double")).alias("_mm"))
    return df.join(m, [*keys, month]).withColumn(
        "ajuste_estacional", rint_round(F.try_divide(F.col(value).cast("double"), F.col("_mm")), 6)).drop("_mm")


def quantile_classes(df: DataFrame, value: str, labels: list[str], name: str) -> DataFrame:
    """D4 (edges ours): classes by the value's quantiles (k labels -> k-1 inner edges, exact).

    The edges are one rank selection used as a scalar subquery; a value equal to an
    edge goes to the lower class.
    """
    k = len(labels)
    ps = [i / k for i in range(1, k)]
    edges = quantiles(df, [], value, ps).select("q").scalar()
    v = F.col(value)
    out = None
    for i in range(k - 1):
        cond = v <= F.element_at(edges, i + 1)
        out = F.when(cond, F.lit(labels[i])) if out is None else out.when(cond, F.lit(labels[i]))
    return df.withColumn(name, F.when(v.isNotNull(), out.otherwise(F.lit(labels[-1]))))


def pivot_points(fact: DataFrame, points: list[str], month: str = "indice_tiempo", point: str = "punto_entrada",
                 value: str = "turistas") -> DataFrame:
    """One row per month, one column per entry point (explicit values: no extra distinct job) and the total."""
    p = fact.groupBy(month).pivot(point, points).agg(F.sum(value).cast("long"))
    total = sum((F.coalesce(F.col(f"`{x}`"), F.lit(0)) for x in points), F.lit(0))
    return p.withColumn("total", total.cast("long"))


def price_rules(clean_q: DataFrame, lo: float = PRICE_MIN, hi: float = PRICE_MAX, max_change: float = MAX_DAILY_CHANGE,
                run_ts: str | None = None, recent_days: int = 7) -> DataFrame:
    """D6 (recent window ours): per house and day, range check and day-over-day change check.

    The daily price is the day's mean (pre-aggregated before any join); the
    previous day comes from an equi-join on (house, day - 1), so no window
    runs over one house's whole history.  ``reciente`` says whether the
    house's last day is within ``recent_days`` of ``run_ts``.
    """
    day = clean_q.groupBy("casa", F.to_date("fecha").alias("dia")).agg(mean_of("venta").alias("precio"))
    prev = day.select("casa", F.date_add("dia", 1).alias("dia"), F.col("precio").alias("precio_anterior"))
    j = day.join(prev, ["casa", "dia"], "left")
    change = rint_round(F.try_divide(F.col("precio") - F.col("precio_anterior"), F.col("precio_anterior")) * F.lit(100.0), 4)
    last = day.groupBy("casa").agg(F.max("dia").alias("ultimo_dia"))
    end = F.to_date(F.lit(run_ts)) if run_ts else F.current_date()
    return j.join(last, "casa").select(
        "casa", "dia", rint_round("precio", 4).alias("precio"),
        ((F.col("precio") >= F.lit(lo)) & (F.col("precio") <= F.lit(hi))).alias("en_rango"),
        change.alias("cambio_pct"),
        F.coalesce(F.abs(change) <= F.lit(max_change), F.lit(True)).alias("cambio_ok"),
        (F.datediff(end, F.col("ultimo_dia")) <= F.lit(recent_days)).alias("reciente"),
    )


def month_gaps(fact: DataFrame, series: str = "punto_entrada", month: str = "indice_tiempo") -> DataFrame:
    """Months with no record, per series, between the overall first and last month.

    The calendar is one ``sequence`` over the overall range (one row per month,
    bounded by the calendar) exploded per series; missing months come from a
    left-anti join against the months present.
    """
    # every branch derives from one aggregate over the same columns, so the fact stage is computed once
    present = fact.groupBy(series, month).agg(F.count("turistas" if "turistas" in fact.columns else F.lit(1)).alias("_n"))
    rng = present.agg(F.min(month).alias("a"), F.max(month).alias("b"))
    first = rng.select("a").scalar()
    last = rng.select("b").scalar()
    months = F.sequence(F.to_date(F.concat(first, F.lit("-01"))), F.to_date(F.concat(last, F.lit("-01"))),
                        F.expr("INTERVAL 1 MONTH"))
    expected = (present.select(series).distinct().select(series, F.explode(months).alias("_d"))
                .select(series, F.date_format("_d", "yyyy-MM").alias(month)))
    return expected.join(present.select(series, month), [series, month], "left_anti")


def run_metrics(ready: DataFrame, coverage: DataFrame, gaps: DataFrame, fact: DataFrame,
                series: str = "punto_entrada", month: str = "indice_tiempo") -> DataFrame:
    """Success rate, join coverage and month completeness in one row (each a scalar subquery)."""
    expected_pairs = fact.select(series, month).distinct().agg(F.count(F.lit(1))).scalar() + \
        gaps.agg(F.count(F.lit(1))).scalar()
    present_pairs = fact.select(series, month).distinct().agg(F.count(F.lit(1))).scalar()
    return ready.select(
        "success_rate",
        coverage.select("quote_pct").scalar().alias("cobertura_precio_pct"),
        coverage.select("interest_pct").scalar().alias("cobertura_interes_pct"),
        rint_round(present_pairs / expected_pairs * F.lit(100.0), 2).alias("completitud_pct"),
    )
