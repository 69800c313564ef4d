"""Summary queries over the curated table.

All are grouped aggregates with partial (map-side) aggregation; none collects
rows to the driver.  ``limit`` is used only where the report is a top-k, and
always under a total order (value, then key) so ties do not make it random.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivo.functions import first_max_by, first_min_by, mean_of, rint_round
from arrivo.operators.ranks import quantiles


def _sum_long(c: str = "turistas"):
    return F.sum(c).cast("long")


def totals_by(df: DataFrame, keys: list[str], value: str = "turistas", with_count: bool = False) -> DataFrame:
    """Sum (and count) of the value per key set."""
    aggs = [_sum_long(value).alias(value)]
    if with_count:
        aggs.append(F.count(F.lit(1)).alias("registros"))
    return df.groupBy(*keys).agg(*aggs)


def top_k(df: DataFrame, keys: list[str], k: int, value: str = "turistas") -> DataFrame:
    """The ``k`` key sets with the largest sum; ties broken by key.

    Planned as TakeOrderedAndProject: each partition keeps its own top k, so
    only k rows per partition reach the final merge.
    """
    g = totals_by(df, keys, value)
    return g.orderBy(F.col(value).desc(), *[F.col(c).asc() for c in keys]).limit(k)


def mean_by(df: DataFrame, keys: list[str], value: str = "turistas") -> DataFrame:
    """Mean per key set (all origins at once, not one query per origin)."""
    return df.groupBy(*keys).agg(mean_of(value).alias(f"{value}_promedio"))


def season_peak(df: DataFrame, group: str = "pais_origen", month: str = "mes", value: str = "turistas") -> DataFrame:
    """Per group, best and worst calendar month of the monthly means, their spread and mean.

    Ties pick the earliest month (pandas ``idxmax``); a zero minimum gives a NULL percent.
    """
    m = mean_by(df, [group, month], value)
    v = f"{value}_promedio"
    g = m.groupBy(group).agg(
        first_max_by(month, v).alias("mes_pico"),
        F.max(v).alias("turistas_pico"),
        first_min_by(month, v).alias("mes_bajo"),
        F.min(v).alias("turistas_bajo"),
        rint_round(F.avg(v), 6).alias("promedio"),
    )
    return g.withColumn(
        "variacion_pct",
        rint_round(F.try_divide(F.col("turistas_pico") - F.col("turistas_bajo"), F.col("turistas_bajo")) * F.lit(100.0), 2),
    )


def box_stats(df: DataFrame, flags: list[str], value: str = "turistas") -> DataFrame:
    """Box-plot numbers for the value split by each 0/1 flag, in one pass over the rows.

    Rows are exploded to ``(flag, level, value)`` so all flags share one
    aggregate; whiskers (most extreme values inside 1.5 IQR) and outlier counts
    need the quartiles first (rank selection), so the quartile table (flags x
    levels rows) is joined back for a second aggregate.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f).cast("int").alias("level")) for f in flags]))
    long = df.select(pairs.alias("p"), F.col(value).cast("double").alias("v")).select("p.flag", "p.level", "v")
    q = long.groupBy("flag", "level").agg(
        F.count("v").alias("n"),
        F.min("v").alias("minimo"),
        F.max("v").alias("maximo"),
    )
    parts = quantiles(long, ["flag", "level"], "v", [0.25, 0.5, 0.75]).select(
        "flag", "level", *[F.element_at("q", k).alias(n) for k, n in enumerate(("q1", "mediana", "q3"), 1)])
    same = q["flag"].eqNullSafe(parts["flag"]) & q["level"].eqNullSafe(parts["level"])
    q = q.join(parts, same, "left").select(q["flag"], q["level"], "n", "q1", "mediana", "q3", "minimo", "maximo")
    lo = F.col("q1") - F.lit(1.5) * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + F.lit(1.5) * (F.col("q3") - F.col("q1"))
    bounds = q.select("flag", "level", lo.alias("lo"), hi.alias("hi"))
    w = long.join(bounds, ["flag", "level"]).groupBy("flag", "level").agg(
        F.min(F.when(F.col("v") >= F.col("lo"), F.col("v"))).alias("bigote_inf"),
        F.max(F.when(F.col("v") <= F.col("hi"), F.col("v"))).alias("bigote_sup"),
        F.count_if((F.col("v") < F.col("lo")) | (F.col("v") > F.col("hi"))).alias("atipicos"),
    )
    return q.join(w, ["flag", "level"])


def distinct_counts(df: DataFrame, cols: list[str], approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Distinct values per column in one aggregate (HyperLogLog++ when ``approx``)."""
    fn = (lambda c: F.approx_count_distinct(F.col(f"`{c}`"), rsd)) if approx else (lambda c: F.count_distinct(F.col(f"`{c}`")))
    return df.agg(*[fn(c).alias(f"n_{c}") for c in cols])


def source_summary(std: DataFrame) -> DataFrame:
    """A17 + A20: per source, rows, total/min/max/mean visitors, entry point and frequency."""
    return std.groupBy("src").agg(
        F.count(F.lit(1)).alias("filas"),
        _sum_long("turistas").alias("turistas_total"),
        F.min("turistas").alias("turistas_min"),
        F.max("turistas").alias("turistas_max"),
        mean_of("turistas").alias("turistas_promedio"),
        F.min("punto_entrada").alias("punto_entrada"),
        F.min("fecha_std").alias("desde"),
        F.max("fecha_std").alias("hasta"),
    )


def date_range(df: DataFrame, key: str = "indice_tiempo", values: list[str] = ()) -> DataFrame:
    """``min - max`` of the month key and mean/median of the given columns (one aggregate)."""
    aggs = [F.min(key).alias("desde"), F.max(key).alias("hasta"), F.count(F.lit(1)).alias("filas")]
    for v in values:
        aggs += [rint_round(mean_of(v), 2).alias(f"{v}_promedio"), rint_round(F.median(v), 6).alias(f"{v}_mediana")]
    out = df.agg(*aggs)
    return out.withColumn("rango", F.concat_ws(" - ", "desde", "hasta"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts with percent of all rows (total as a scalar subquery)."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.groupBy(F.col(col).alias("valor")).agg(F.count(F.lit(1)).alias("n")).select(
        "valor", "n", rint_round(F.col("n") / total * F.lit(100.0), 2).alias("pct"))


def head(df: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """O1 / O2: the first ``n`` rows in key order (a head needs an order to be defined)."""
    return df.orderBy(*keys).limit(n)


def sample_rows(df: DataFrame, n: int, keys: list[str], seed: int = 42) -> DataFrame:
    """``min(n, rows)`` rows chosen by a seeded hash of the keys.

    The hash is ``md5`` of the keys and the seed joined with ``|`` (a function
    other engines share, so the choice can be checked elsewhere).  Independent
    of partitioning and of row order; planned as a top-k over the hash, so no
    full sort.  Not the same rows pandas ``sample`` would take.
    """
    h = F.md5(F.concat_ws("|", *[F.col(f"`{k}`").cast("string") for k in keys], F.lit(str(seed))))
    return df.withColumn("_h", h).orderBy("_h", *keys).limit(n).drop("_h")
