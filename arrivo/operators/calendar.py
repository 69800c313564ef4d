"""Time and calendar operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month names used for the dummy columns, and event months.
MONTH_NAMES = ["enero", "febrero", "marzo", "abril", "mayo", "junio",
               "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre"]
HARVEST_MONTHS = (2, 3)
WINTER_BREAK_MONTHS = (7, 8)
HIGH_SEASON_MONTHS = (1, 2, 3, 7, 8, 12)
PANDEMIC_YEARS = (2020, 2021)
ERA_LABELS = ("Pandemia COVID-19", "Pre-Pandemia (2014-2019)", "Post-Pandemia (2022+)")


def quarter_months(d) -> Column:
    """The three month starts of the quarter holding ``d`` (an array of DATE)."""
    q = F.trunc(F.col(d).cast("date") if isinstance(d, str) else d.cast("date"), "quarter")
    return F.sequence(q, F.add_months(q, 2), F.expr("INTERVAL 1 MONTH"))


def expand_by_frequency(df: DataFrame, date_col: str, value_col: str, freq_col: str = "frequency",
                        quarterly: str = "trimestral", divisor: int = 3) -> DataFrame:
    """T1 + T2: quarterly rows become three monthly rows with ``int(v / 3)``; others keep their month.

    One ``explode`` over an array chosen per row: no per-source branch, no job.
    The value is truncated toward zero like Python ``int``, so up to
    ``divisor - 1`` units per row are lost (quirk Q1, reported by ``conservation``).
    """
    is_q = F.col(freq_col) == F.lit(quarterly)
    d = F.col(date_col).cast("date")
    months = F.when(is_q, quarter_months(d)).otherwise(F.array(F.trunc(d, "month")))
    value = F.when(is_q, (F.col(value_col) / F.lit(divisor)).cast("long")).otherwise(F.col(value_col).cast("long"))
    return (
        df.withColumn("fecha_std", F.explode(months))
        .withColumn(value_col, value)
        .withColumn("indice_tiempo", F.date_format("fecha_std", "yyyy-MM"))
    )


def year_month_cols(key: str = "indice_tiempo") -> dict:
    """T5 expressions: ``año`` and ``mes`` integers from a ``yyyy-MM`` key (NULL when the key has no dash)."""
    k = F.col(key)
    has = k.contains("-")
    return {
        "año": F.when(has, F.split_part(k, F.lit("-"), F.lit(1)).try_cast("int")),
        "mes": F.when(has, F.split_part(k, F.lit("-"), F.lit(2)).try_cast("int")),
    }


def year_month(df: DataFrame, key: str = "indice_tiempo") -> DataFrame:
    """T5: add ``año`` and ``mes``."""
    return df.withColumns(year_month_cols(key))


def dummy_cols(m: Column) -> dict:
    """T6 expressions: twelve 0/1 columns ``es_<month>`` (NULL month gives 0, as pandas)."""
    return {f"es_{name}": F.coalesce((m == F.lit(i + 1)).cast("int"), F.lit(0)) for i, name in enumerate(MONTH_NAMES)}


def flag_cols(m: Column, harvest=HARVEST_MONTHS, winter=WINTER_BREAK_MONTHS, high=HIGH_SEASON_MONTHS) -> dict:
    """T7 expressions (also used for scoring, quirk Q6): harvest, winter break and high season."""
    return {
        "mes_vendimia": F.coalesce(m.isin(*harvest).cast("int"), F.lit(0)),
        "vacaciones_invierno": F.coalesce(m.isin(*winter).cast("int"), F.lit(0)),
        "temporada_alta": F.coalesce(m.isin(*high).cast("int"), F.lit(0)),
    }


def month_dummies(df: DataFrame, month: str = "mes") -> DataFrame:
    """Add the twelve month dummies."""
    return df.withColumns(dummy_cols(F.col(month)))


def event_flags(df: DataFrame, month: str = "mes", harvest=HARVEST_MONTHS, winter=WINTER_BREAK_MONTHS,
                high=HIGH_SEASON_MONTHS) -> DataFrame:
    """Add the three event flags."""
    return df.withColumns(flag_cols(F.col(month), harvest, winter, high))


def calendar_sql(key: str = "indice_tiempo") -> list[tuple[str, str]]:
    """T5 + T6 + T7 as ``(name, SQL expression)`` pairs (added in one JVM call)."""
    has = f"contains(`{key}`, '-')"
    mes = f"(CASE WHEN {has} THEN try_cast(split_part(`{key}`, '-', 2) AS INT) END)"
    out = [("año", f"CASE WHEN {has} THEN try_cast(split_part(`{key}`, '-', 1) AS INT) END"), ("mes", mes)]
    out += [(f"es_{name}", f"coalesce(CAST({mes} = {i + 1} AS INT), 0)") for i, name in enumerate(MONTH_NAMES)]
    for name, months in (("mes_vendimia", HARVEST_MONTHS), ("vacaciones_invierno", WINTER_BREAK_MONTHS),
                         ("temporada_alta", HIGH_SEASON_MONTHS)):
        out.append((name, f"coalesce(CAST({mes} IN ({', '.join(map(str, months))}) AS INT), 0)"))
    return out


def calendar_features(df: DataFrame, key: str = "indice_tiempo") -> DataFrame:
    """T5 + T6 + T7 in one projection."""
    keep = [f"`{c}`" for c in df.columns if c not in ("año", "mes")]
    return df.selectExpr(*keep, *[f"{e} AS `{n}`" for n, e in calendar_sql(key)])


def month_date(year="año", month="mes") -> Column:
    """Month start from year and month numbers."""
    return F.make_date(F.col(year), F.col(month), F.lit(1))


def era(year="año", pandemic=PANDEMIC_YEARS) -> Column:
    """Era label of a year: pandemic years, before them, after them."""
    y = F.col(year)
    return (
        F.when(y.isin(*pandemic), F.lit(ERA_LABELS[0]))
        .when(y < F.lit(min(pandemic)), F.lit(ERA_LABELS[1]))
        .otherwise(F.lit(ERA_LABELS[2]))
    )


# Month labels used by the dashboard.
MONTH_LABELS = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
                "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre"]


def month_label(month="mes") -> Column:
    """Month number to label through a literal map."""
    m = F.create_map(*[x for i, lab in enumerate(MONTH_LABELS) for x in (F.lit(i + 1), F.lit(lab))])
    return F.element_at(m, F.col(month))
