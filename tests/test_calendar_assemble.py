"""Quarter expansion, calendar flags, fact aggregate, side tables, median flags and rank."""

import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from arrivo.operators import assemble, calendar
from arrivo.plans import pipeline as pl


def test_quarter_expansion_truncates(spark):
    df = spark.createDataFrame([(dt.date(2014, 5, 17), 100, "trimestral"), (dt.date(2014, 5, 17), 7, "mensual")],
                               "d date, v long, frequency string")
    out = calendar.expand_by_frequency(df, "d", "v").orderBy("frequency", "fecha_std").collect()
    q = [(r["indice_tiempo"], r["v"]) for r in out if r["frequency"] == "trimestral"]
    assert q == [("2014-04", 33), ("2014-05", 33), ("2014-06", 33)]
    assert [(r["indice_tiempo"], r["v"]) for r in out if r["frequency"] == "mensual"] == [("2014-05", 7)]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=10_000), min_size=1, max_size=20))
def test_expansion_properties(spark, values):
    rows = [(dt.date(2015, 1 + 3 * (i % 4), 1), v, "trimestral") for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "d date, v long, frequency string")
    out = calendar.expand_by_frequency(df, "d", "v")
    assert out.count() == 3 * len(values)
    lost = sum(values) - out.agg(F.sum("v")).first()[0]
    assert 0 <= lost <= 2 * len(values)


def test_calendar_features(spark):
    df = spark.createDataFrame([("2014-02",), ("2014-07",), ("2014-12",), ("bad",)], "indice_tiempo string")
    rows = {r["indice_tiempo"]: r for r in calendar.calendar_features(df).collect()}
    assert rows["2014-02"]["mes_vendimia"] == 1 and rows["2014-02"]["temporada_alta"] == 1
    assert rows["2014-07"]["vacaciones_invierno"] == 1 and rows["2014-07"]["es_julio"] == 1
    assert rows["2014-12"]["mes_vendimia"] == 0 and rows["2014-12"]["temporada_alta"] == 1
    assert rows["bad"]["mes"] is None and rows["bad"]["es_enero"] == 0


def test_quote_spread_and_zero_min(spark):
    q = spark.createDataFrame([(dt.datetime(2020, 1, 2), 36.0), (dt.datetime(2020, 1, 3), 40.0),
                               (dt.datetime(2020, 2, 2), 0.0), (dt.datetime(2020, 2, 3), 5.0)],
                              "fecha timestamp_ntz, venta double")
    m = {r["indice_tiempo"]: r for r in assemble.quotes_monthly(q).collect()}
    assert m["2020-01"]["variacion_usd_mensual"] == 4.0 and m["2020-01"]["variacion_porcentual_usd"] == 11.11
    assert m["2020-02"]["variacion_porcentual_usd"] is None


def test_fact_conserves_totals(spark, sf):
    row = assemble.conservation(
        pl.raw_arrivals(spark, sf).filter(F.col("period") >= F.lit(pl.DEFAULT.start).cast("date")),
        pl.standardised(spark, sf), pl.fact(spark, sf)).first()
    assert row["ok"] and row["aggregation_diff"] == 0
    assert 0 <= row["expansion_loss"] <= 2 * row["rows_raw"]


def test_median_flags_weighted_by_rows(spark):
    fact = spark.createDataFrame([("2020-01", "a", "p", 1), ("2020-01", "b", "p", 1), ("2020-01", "c", "p", 1),
                                  ("2020-02", "a", "p", 1), ("2020-03", "a", "p", 1)],
                                 "indice_tiempo string, pais_origen string, punto_entrada string, turistas long")
    qm = spark.createDataFrame([("2020-01", 10.0, 1.0), ("2020-02", 20.0, 2.0)],
                               "indice_tiempo string, precio_promedio_usd double, variacion_usd_mensual double")
    for c in ("precio_minimo_usd", "precio_maximo_usd", "variacion_porcentual_usd"):
        qm = qm.withColumn(c, F.lit(None).cast("double"))
    qm = qm.withColumn("dias", F.lit(1).cast("long"))
    out = assemble.join_quotes(fact, qm).collect()
    # joined prices: 10, 10, 10, 20 (the March row has none): median 10, so only 20 is high
    assert sorted((r["indice_tiempo"], r["usd_alto"]) for r in out) == [
        ("2020-01", 0), ("2020-01", 0), ("2020-01", 0), ("2020-02", 1), ("2020-03", 0)]


def test_positional_rank_is_global_row_number(spark, sf):
    from pyspark.sql import Window

    f = pl.fact(spark, sf)
    r = assemble.positional_rank(f)
    ref = f.withColumn("rn", F.row_number().over(Window.orderBy(*assemble.KEYS)))
    diff = r.join(ref, assemble.KEYS).filter(F.col("pos") != F.col("rn")).count()
    assert diff == 0 and r.count() == f.count()
