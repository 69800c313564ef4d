"""Profiling and data quality of a table (Q-1 to Q-12, Q-19, Q-21, Q-23).

Each profile is one aggregate with many expressions (never one job per
column), reshaped to long form with ``stack``.  Means and standard deviations
take the values as they are and are rounded to 12 significant digits, so they
are the same on any partitioning; quantiles are exact (rank selection, ``ranks.quantiles``) unless an ``accuracy``
is given, which switches to ``percentile_approx``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivo.functions import correlation, first_max_by, mean_of, rint_round, std_of
from arrivo.operators.ranks import quantiles

# Date-like columns that are never features.
DATE_DENY = ["indice_tiempo", "fecha", "mes_ano", "indice_tiempo_dt"]


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Numeric columns in table order (booleans excluded), minus ``exclude``."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def text_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def _quantiles(df: DataFrame, by: list[str], value: str, ps: list[float], accuracy: int | None) -> DataFrame:
    """``by`` and q, the array of quantiles: exact, or by a sketch of the given accuracy."""
    if not accuracy:
        return quantiles(df, by, value, ps).select(*by, "q")
    x = F.col(f"`{value}`").cast("double")
    sketch = F.percentile_approx(x, F.array(*[F.lit(p) for p in ps]), F.lit(accuracy))
    return df.groupBy(*by).agg(sketch.cast("array<double>").alias("q"))


def to_long(df: DataFrame, cols: list[str], key: str = "columna", value: str = "v", cast: str = "double") -> DataFrame:
    """Unpivot ``cols`` to ``(key, value)`` rows with one ``stack`` projection (no shuffle)."""
    parts = ", ".join(f"'{c}', CAST(`{c}` AS {cast})" for c in cols)
    return df.selectExpr(f"stack({len(cols)}, {parts}) as ({key}, {value})")


def describe(df: DataFrame, cols: list[str] | None = None, accuracy: int | None = None) -> DataFrame:
    """Q-1: count, mean, std, min, quartiles, max of every numeric column, one row per column.

    Columns are stacked to long form and grouped by name, so one aggregate
    serves every column, and one rank selection all quartiles.  NULLs are
    skipped, as pandas does.
    """
    cols = cols or numeric_columns(df)
    long = to_long(df, cols)
    v = F.col("v")
    g = long.groupBy("columna").agg(
        F.count(v).alias("count"),
        rint_round(mean_of(v), 6).alias("mean"),
        rint_round(std_of(v), 6).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    ).join(_quantiles(long, ["columna"], "v", [0.25, 0.5, 0.75], accuracy).withColumnRenamed("q", "_q"), "columna", "left")
    return g.select(
        "columna", "count", "mean", "std", "min",
        *[rint_round(F.element_at("_q", i + 1).cast("double"), 6).alias(n) for i, n in enumerate(("q25", "q50", "q75"))],
        "max",
    )


def target_profile(df: DataFrame, target: str = "turistas") -> DataFrame:
    """Q-2: mean, median, std, min, max, range, coefficient of variation and its band."""
    t = _q(target)
    g = df.agg(
        mean_of(t).alias("media"),
        rint_round(std_of(t), 6).alias("desviacion"),
        F.min(t).cast("double").alias("minimo"),
        F.max(t).cast("double").alias("maximo"),
    )
    median = quantiles(df, [], target, [0.5]).select(F.element_at("q", 1)).scalar()
    g = g.select("media", median.alias("mediana"), "desviacion", "minimo", "maximo")
    cv = rint_round(F.try_divide(F.col("desviacion"), F.col("media")) * F.lit(100.0), 2)
    return g.select(
        "*", (F.col("maximo") - F.col("minimo")).alias("rango"), cv.alias("cv_pct"),
    ).withColumn(
        "variabilidad",
        F.when(F.col("cv_pct") > 100, F.lit("alta")).when(F.col("cv_pct") > 50, F.lit("moderada")).otherwise(F.lit("baja")),
    )


def column_kinds(df: DataFrame, target: str = "turistas", deny=DATE_DENY, approx: bool = False) -> DataFrame:
    """Q-3: numeric and categorical feature columns (target and date columns removed) with cardinality."""
    num = numeric_columns(df, exclude=[target, *deny])
    cat = text_columns(df, exclude=[target, *deny])
    cnt = (lambda c: F.approx_count_distinct(_q(c))) if approx else (lambda c: F.count_distinct(_q(c)))
    cols = num + cat
    g = df.agg(*[cnt(c).alias(f"n__{c}") for c in cols])
    parts = ", ".join(f"'{c}', '{'numerica' if c in num else 'categorica'}', `n__{c}`" for c in cols)
    return g.selectExpr(f"stack({len(cols)}, {parts}) as (columna, tipo, n_distintos)")


def null_report(df: DataFrame, only_with_nulls: bool = True) -> DataFrame:
    """Q-4: per column, null count and percent of rows (rounded half-even to 2)."""
    cols = df.columns
    g = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count_if(_q(c).isNull()).alias(f"nulos__{c}") for c in cols])
    parts = ", ".join(f"'{c}', `nulos__{c}`" for c in cols)
    out = g.selectExpr("__rows", f"stack({len(cols)}, {parts}) as (columna, nulos)")
    out = out.select("columna", "nulos", rint_round(F.col("nulos") / F.col("__rows") * F.lit(100.0), 2).alias("pct"))
    return out.filter(F.col("nulos") > 0) if only_with_nulls else out


def with_digests(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Text columns replaced by their SHA-256 digest (NULL stays NULL), so that no later exchange carries the texts."""
    cols = cols or text_columns(df)
    return df.select(*[F.unhex(F.sha2(_q(c), 256)).alias(c) if c in cols else _q(c) for c in df.columns])


def duplicates(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Q-5: rows that repeat an earlier row (all columns), and their share of all rows.

    Texts are compared by SHA-256, taken before the only exchange; rows and
    duplicates come from one aggregate over the groups.
    """
    thin = with_digests(df.select(*[_q(c) for c in cols]) if cols else df)
    g = thin.groupBy(*[_q(c) for c in thin.columns]).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("filas"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicados"))
    return g.withColumn("pct", rint_round(F.try_divide(F.col("duplicados"), F.col("filas")) * F.lit(100.0), 2))


def iqr_bounds(df: DataFrame, target: str = "turistas", k: float = 1.5, accuracy: int | None = None) -> DataFrame:
    """Q-6 (first half): one row with Q1, Q3, IQR and the outlier bounds."""
    both = _quantiles(df, [], target, [0.25, 0.75], accuracy).agg(F.first("q").alias("q"))  # one row, also without values
    g = both.select(F.element_at("q", 1).alias("q1"), F.element_at("q", 2).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return g.select("q1", "q3", iqr.alias("iqr"), (F.col("q1") - F.lit(k) * iqr).alias("limite_inferior"),
                    (F.col("q3") + F.lit(k) * iqr).alias("limite_superior"))


def iqr_outliers(df: DataFrame, target: str = "turistas", k: float = 1.5, accuracy: int | None = None) -> DataFrame:
    """Q-6: bounds plus the count and percent of rows outside them (bounds as scalar subqueries)."""
    b = iqr_bounds(df, target, k, accuracy)
    both = b.select(F.struct("limite_inferior", "limite_superior")).scalar()
    x = _q(target)
    c = df.agg(F.count_if((x < both["limite_inferior"]) | (x > both["limite_superior"])).alias("atipicos"), F.count(F.lit(1)).alias("filas"))
    return b.crossJoin(c).select(*b.columns, "atipicos", rint_round(F.col("atipicos") / F.col("filas") * F.lit(100.0), 2).alias("pct"))  # one row each


def top_outliers(df: DataFrame, target: str = "turistas", n: int = 5, context=("año", "mes", "pais_origen", "punto_entrada"),
                 keys=("indice_tiempo", "pais_origen", "punto_entrada"), k: float = 1.5) -> DataFrame:
    """Q-7 / O3: the ``n`` largest rows above the upper bound, with context columns (ties by key)."""
    hi = iqr_bounds(df, target, k).select("limite_superior").scalar()
    cols = [c for c in context if c in df.columns]
    return (df.filter(_q(target) > hi)
            .orderBy(_q(target).desc(), *[_q(c) for c in keys])
            .limit(n).select(*[_q(c) for c in cols], _q(target)))


def zero_share(df: DataFrame, target: str = "turistas") -> DataFrame:
    """Q-8: rows with a zero target and their percent."""
    g = df.agg(F.count_if(_q(target) == 0).alias("ceros"), F.count(F.lit(1)).alias("filas"))
    return g.withColumn("pct", rint_round(F.col("ceros") / F.col("filas") * F.lit(100.0), 2))


def zero_by(df: DataFrame, key: str, target: str = "turistas") -> DataFrame:
    """Q-9 / Q-10: zero rows per key with the key's row count and share (keys with at least one zero)."""
    g = df.groupBy(_q(key).alias(key)).agg(F.count_if(_q(target) == 0).alias("ceros"), F.count(F.lit(1)).alias("filas"))
    return g.filter(F.col("ceros") > 0).withColumn(
        "pct", rint_round(F.col("ceros") / F.col("filas") * F.lit(100.0), 2))


def worst_key(zero_table: DataFrame, key: str) -> DataFrame:
    """Q-9: the key with most zeros (ties: the smallest key, as ``idxmax`` on a sorted index)."""
    return zero_table.agg(first_max_by(key, "ceros").alias(key), F.max("ceros").alias("ceros"))


def top_zero(df: DataFrame, key: str, n: int = 5, target: str = "turistas") -> DataFrame:
    """Q-10: the ``n`` keys with most zero rows (ties by key)."""
    return zero_by(df, key, target).orderBy(F.col("ceros").desc(), _q(key)).limit(n).select(key, "ceros")


def correlation_columns(df: DataFrame, cols: list[str] | None = None, drop=("interes_alto",)) -> tuple[list[str], list[float]]:
    """Q-11 (first pass): kept columns and their means.

    A column is dropped when it is constant (``min == max``), has fewer than
    two values (its correlations are all NaN) or is listed in ``drop``.  One
    row of numbers per column is read on the driver: their number is the
    column count, not the row count.
    """
    cols = [c for c in (cols or numeric_columns(df)) if c not in drop]
    stats = to_long(df, cols).groupBy("columna").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.avg("v").alias("m"), F.count("v").alias("n"))
    found = {r["columna"]: r["m"] for r in stats.collect() if r["n"] >= 2 and r["lo"] != r["hi"]}
    keep = [c for c in cols if c in found]
    return keep, [found[c] for c in keep]


def correlation_exclusions(df: DataFrame, cols: list[str] | None = None, drop=("interes_alto",)) -> DataFrame:
    """Numeric columns left out of the correlation matrix, with the reason (one aggregate, long form)."""
    cols = cols or numeric_columns(df)
    long = to_long(df, cols)
    g = long.groupBy("columna").agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    reason = (F.when(F.col("columna").isin(*drop), F.lit("excluida"))
              .when(F.col("n") < 2, F.lit("sin_datos"))
              .when(F.col("lo") == F.col("hi"), F.lit("constante")))
    return g.select("columna", reason.alias("motivo")).filter(F.col("motivo").isNotNull())


def _gram_blocks(cols: list[str], means: list[float]):
    """Per-partition sums for pairwise-complete Pearson correlation (NumPy on Arrow batches).

    With ``Xc`` the centred values (0 where NULL) and ``M`` the non-NULL mask,
    the blocks ``Xc'Xc``, ``Xc'M``, ``(Xc*Xc)'M`` and ``M'M`` hold, for every
    column pair, the co-moment, the partial sums and the pair count over the
    rows where both are present.  Each task returns one row of 4*k*k numbers.
    """
    import numpy as np
    import pandas as pd

    mu = np.asarray(means, dtype=float)

    def fn(batches):
        acc = None
        for pdf in batches:
            x = pdf[cols].to_numpy(dtype=float, na_value=np.nan)
            m = ~np.isnan(x)
            xc = np.where(m, x - mu, 0.0)
            mf = m.astype(float)
            blocks = np.stack([xc.T @ xc, xc.T @ mf, (xc * xc).T @ mf, mf.T @ mf])
            acc = blocks if acc is None else acc + blocks
        if acc is not None:
            yield pd.DataFrame({"g": [acc.ravel()]})

    return fn


def correlations(df: DataFrame, cols: list[str] | None = None, drop=("interes_alto",)) -> DataFrame:
    """Q-11: Pearson correlation of every pair of kept columns (pairwise-complete rows, like pandas).

    One pass over the rows: each partition reduces its rows to 4*k*k sums
    (``_gram_blocks``), the sums are added by position (a k*k-sized
    aggregate, independent of the row count), and the correlation of each pair
    is formed from them.  Values are rounded to 6 places.
    """
    keep, means = correlation_columns(df, cols, drop)
    k = len(keep)
    if k < 2:
        return df.sparkSession.createDataFrame([], "columna_a string, columna_b string, correlacion double")
    x = df.select(*[_q(c).cast("double").alias(c) for c in keep])
    parts = x.mapInPandas(_gram_blocks(keep, means), "g array<double>")
    sums = parts.select(F.posexplode("g").alias("pos", "v")).groupBy("pos").agg(F.sum("v").alias("v"))
    kk = k * k
    cell = sums.select(
        (F.col("pos") / F.lit(kk)).cast("int").alias("blk"),
        ((F.col("pos") % F.lit(kk)) / F.lit(k)).cast("int").alias("i"),
        (F.col("pos") % F.lit(k)).cast("int").alias("j"),
        "v",
    )
    # each unordered pair (i < j) needs cells (i, j) and (j, i) of the blocks
    lo, hi = F.least("i", "j"), F.greatest("i", "j")
    first = F.col("i") < F.col("j")
    pair = cell.filter(F.col("i") != F.col("j")).groupBy(lo.alias("a"), hi.alias("b")).agg(
        F.max(F.when((F.col("blk") == 0) & first, F.col("v"))).alias("sxy"),
        F.max(F.when((F.col("blk") == 1) & first, F.col("v"))).alias("sx_b"),      # sum of x_a where b present
        F.max(F.when((F.col("blk") == 1) & ~first, F.col("v"))).alias("sy_a"),     # sum of x_b where a present
        F.max(F.when((F.col("blk") == 2) & first, F.col("v"))).alias("sxx_b"),
        F.max(F.when((F.col("blk") == 2) & ~first, F.col("v"))).alias("syy_a"),
        F.max(F.when((F.col("blk") == 3) & first, F.col("v"))).alias("n"),
    )
    cov = F.col("sxy") - F.col("sx_b") * F.col("sy_a") / F.col("n")
    vx = F.col("sxx_b") - F.col("sx_b") * F.col("sx_b") / F.col("n")
    vy = F.col("syy_a") - F.col("sy_a") * F.col("sy_a") / F.col("n")
    r = F.when((F.col("n") >= 2) & (vx > 0) & (vy > 0), cov / F.sqrt(vx * vy))
    names = F.array(*[F.lit(c) for c in keep])
    return pair.select(
        F.element_at(names, F.col("a") + 1).alias("columna_a"),
        F.element_at(names, F.col("b") + 1).alias("columna_b"),
        rint_round(r, 6).alias("correlacion"),
    )


def target_correlations(df: DataFrame, target: str = "turistas", n: int = 10, drop=("interes_alto",)) -> DataFrame:
    """Q-12: the ``n`` columns most correlated with the target (largest first, ties by name); one aggregate, long form.

    A column that is constant over the rows with a target has no correlation and is left out.
    """
    cols = [c for c in numeric_columns(df, exclude=[target, *drop])]
    parts = ", ".join(f"'{c}', CAST(`{c}` AS double)" for c in cols)
    long = df.selectExpr(f"`{target}` AS __target", f"stack({len(cols)}, {parts}) AS (columna, v)")
    t = long.groupBy("columna").agg(rint_round(correlation("__target", "v"), 6).alias("correlacion"))
    return (t.filter(F.col("correlacion").isNotNull() & ~F.isnan("correlacion"))
            .orderBy(F.col("correlacion").desc(), "columna").limit(n))


def category_catalog(df: DataFrame, cols: list[str]) -> DataFrame:
    """Q-21: per categorical column, every value with count and percent (long form, sorted on output)."""
    total = df.agg(F.count(F.lit(1))).scalar()
    parts = [df.groupBy(_q(c).alias("valor")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(c).alias("columna"), "valor", "n")
             for c in cols]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("pct", rint_round(F.col("n") / total * F.lit(100.0), 2))


def shape(df: DataFrame) -> DataFrame:
    """Q-23: rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("filas")).withColumn("columnas", F.lit(len(df.columns)))
