"""What-if scoring.

A scenario fixes year, month, price and optionally one origin / entry point.
Every other numeric feature takes its median over the history table and every
other category its most frequent value.  The grid of origins x entry points
comes from the category domains (bounded by the model's one-hot width), is
built by exploding the domain arrays of one aggregate row (no join), and is
scored with one ``transform``: thousands of scenarios cost one plan, not a
loop of one-row predictions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivo.functions import rint_round
from arrivo.operators.calendar import calendar_sql
from arrivo.operators.profile import to_long
from arrivo.operators.ranks import quantiles

# Demand bands relative to the train mean.
DEMAND_BANDS = [(1.5, "Demanda Muy Alta"), (1.0, "Demanda Por Encima del Promedio"), (0.7, "Demanda Moderada")]
LOW_DEMAND = "Demanda Baja"
# Domains and constants used without a model's metadata and without history.
DEFAULT_DOMAINS = {
    "pais_origen": ["Brasil", "Chile", "EEUU, Canadá y México", "Europa y Resto del Mundo", "Paraguay", "Resto de América", "Uruguay"],
    "punto_entrada": ["Aeropuerto Buenos Aires", "Aeropuerto Córdoba", "Aeropuerto Mendoza", "Paso Cristo Redentor", "Puerto Buenos Aires"],
}
DEFAULT_PRICE, DEFAULT_NUMBER, DEFAULT_CATEGORY = 850.0, 0.0, "Desconocido"
CALENDAR_COLS = ["año", "mes", "es_enero", "es_febrero", "es_marzo", "es_abril", "es_mayo", "es_junio", "es_julio",
                 "es_agosto", "es_septiembre", "es_octubre", "es_noviembre", "es_diciembre",
                 "mes_vendimia", "vacaciones_invierno", "temporada_alta"]


@dataclass(frozen=True)
class Scenario:
    year: int
    month: int
    price: float
    origin: str | None = None   # None: every origin
    point: str | None = None    # None: every entry point


def defaults(history: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """One row with the exact median of each numeric feature (rounded to 6), from one rank selection."""
    med = quantiles(to_long(history, numeric), ["columna"], "v", [0.5]).select("columna", rint_round(F.element_at("q", 1), 6).alias("m"))
    return med.groupBy().pivot("columna", numeric).agg(F.first("m"))


def model_domains(train: DataFrame, cols=("pais_origen", "punto_entrada")) -> DataFrame:
    """The sorted domains that a model was trained on, one row with an array per column (its metadata)."""
    return train.agg(*[F.sort_array(F.collect_set(c)).alias(c) for c in cols])


def constant(feature: str) -> float:
    """The value of a numeric feature without a history table."""
    return DEFAULT_PRICE if "precio" in feature.lower() or "usd" in feature.lower() else DEFAULT_NUMBER


def grid(history: DataFrame | None, numeric: list[str], categorical: list[str], sc: Scenario,
         origin_col: str = "pais_origen", point_col: str = "punto_entrada", metadata: DataFrame | None = None,
         spark=None) -> DataFrame:
    """J5 + M19 + M25: the scenario rows, one per (origin, entry point) of the chosen domains.

    A domain comes from the model's ``metadata`` (``model_domains``), else from
    the sorted distinct values of the history (scalar subqueries over one
    aggregate), else from the defaults; a fixed origin or point replaces it.
    Without a history (``spark`` given instead) features take constants.  Only the
    mean price follows the scenario (quirk Q7); calendar columns are rebuilt
    from the scenario month with the training calendar (quirk Q6 fixed).
    """
    def domain(col: str, fixed: str | None):
        if fixed is not None:
            return F.array(F.lit(fixed))
        if metadata is not None:
            return metadata.select(col).scalar()
        if history is not None:
            return history.agg(F.sort_array(F.collect_set(col))).scalar()
        return F.array(*[F.lit(v) for v in DEFAULT_DOMAINS[col]])

    base = (defaults(history, numeric, categorical) if history is not None
            else spark.range(1).select(*[F.lit(constant(c)).alias(c) for c in numeric]))
    dom_o, dom_p = domain(origin_col, sc.origin), domain(point_col, sc.point)
    other_cat = [c for c in categorical if c not in (origin_col, point_col)]
    modes = {c: history.agg(F.mode(F.col(c), True)).scalar() if history is not None else F.lit(DEFAULT_CATEGORY) for c in other_cat}
    g = base.select("*", F.explode(dom_o).alias(origin_col)).select("*", F.explode(dom_p).alias(point_col))
    g = g.withColumn("indice_tiempo", F.lit(f"{sc.year:04d}-{sc.month:02d}"))
    cal = dict(calendar_sql("indice_tiempo"))

    def value(c):
        if c == "precio_promedio_usd":
            return F.lit(float(sc.price))
        if c in cal:
            return F.expr(cal[c])
        return F.col(f"`{c}`")

    return g.select(F.col(origin_col), F.col(point_col), *[m.alias(c) for c, m in modes.items()],
                    *[value(c).cast("double").alias(c) for c in numeric])



def score(model, rows: DataFrame) -> DataFrame:
    """One ``transform`` of all scenario rows."""
    return model.transform(rows)


def rollup(scored: DataFrame, train_mean, train_max, rmse, origin_col: str = "pais_origen",
           point_col: str = "punto_entrada", top: int = 5) -> DataFrame:
    """M20 + M22 + M23 + M24: per-origin totals with share, rank, top, breakdown, and the scenario's overall numbers.

    Totals are grouped sums; the scenario total and origin count are scalar
    subqueries (one value each), the rank is a window over the per-origin
    table (one row per origin, bounded by the category domain).
    """
    from pyspark.sql import Window

    part = F.struct(F.col(point_col).alias("p"), F.rint("prediction").cast("long").alias("v"))
    per = scored.groupBy(origin_col).agg(F.sum("prediction").alias("prediccion"), F.count(F.lit(1)).alias("puntos"),
                                         F.sort_array(F.collect_list(part)).alias("_parts"))
    rank = F.rank().over(Window.orderBy(F.col("prediccion").desc(), origin_col))
    total = scored.agg(F.sum("prediction")).scalar()
    n_orig = scored.agg(F.count_distinct(origin_col)).scalar()
    interval = F.lit(rmse) * F.sqrt(n_orig.cast("double"))
    return per.select(
        origin_col, "puntos", "prediccion",
        rint_round(F.col("prediccion") / total * F.lit(100.0), 1).alias("pct_total"),
        rank.alias("rank"), (rank <= top).alias(f"top_{top}"),
        F.array_join(F.transform("_parts", lambda x: F.concat(x["p"], F.lit(": "), x["v"].cast("string"))), ", ").alias("desglose"),
        total.alias("total"), (total / n_orig).alias("promedio_por_pais"),
        (F.try_divide(total - F.lit(train_mean), F.lit(train_mean)) * F.lit(100.0)).alias("vs_media_pct"),
        (F.try_divide(total, F.lit(train_max)) * F.lit(100.0)).alias("pct_maximo"),
        demand_band(total, train_mean).alias("demanda"),
        F.greatest(F.lit(0.0), total - interval).alias("intervalo_inf"),
        (total + interval).alias("intervalo_sup"),
    )


def demand_band(value, mean) -> F.Column:
    """Band of a predicted total relative to the train mean."""
    out = None
    for k, name in DEMAND_BANDS:
        cond = value > F.lit(mean) * F.lit(k)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(F.lit(LOW_DEMAND))


def single_origin(scored: DataFrame, train_mean, train_max, rmse, point_col: str = "punto_entrada") -> DataFrame:
    """M21 + M22 + M23 + M24: one origin over its entry points: shares, history comparison, band, interval."""
    total = scored.agg(F.sum("prediction")).scalar()
    return scored.select(
        point_col, F.col("prediction").alias("prediccion"),
        rint_round(F.col("prediction") / total * F.lit(100.0), 1).alias("pct_total"),
        total.alias("total"),
        (F.try_divide(total - F.lit(train_mean), F.lit(train_mean)) * F.lit(100.0)).alias("vs_media_pct"),
        (F.try_divide(total, F.lit(train_max)) * F.lit(100.0)).alias("pct_maximo"),
        demand_band(total, train_mean).alias("demanda"),
        F.greatest(F.lit(0.0), total - F.lit(rmse)).alias("intervalo_inf"),
        (total + F.lit(rmse)).alias("intervalo_sup"),
    )
