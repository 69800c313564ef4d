"""Configuration-declared extras and scenario scoring."""

from pyspark.sql import functions as F

from arrivo.operators import extras
from arrivo.operators import scenario as SC


def _fact(spark, rows):
    return spark.createDataFrame(rows, "indice_tiempo string, pais_origen string, punto_entrada string, turistas long")


def test_lags_are_gap_safe(spark):
    f = _fact(spark, [("2020-01", "a", "p", 10), ("2020-02", "a", "p", 20), ("2020-04", "a", "p", 40),
                      ("2021-01", "a", "p", 15)])
    got = {r["indice_tiempo"]: r for r in extras.lags(f).collect()}
    assert got["2020-02"]["lag_1"] == 10 and got["2020-02"]["crecimiento_1"] == 100.0
    assert got["2020-04"]["lag_1"] is None  # March is missing: no value shifted in
    assert got["2021-01"]["lag_12"] == 10 and got["2021-01"]["crecimiento_12"] == 50.0


def test_month_gaps_per_series(spark):
    f = _fact(spark, [("2020-01", "a", "p", 1), ("2020-03", "a", "p", 1), ("2020-01", "a", "q", 1),
                      ("2020-02", "a", "q", 1), ("2020-03", "a", "q", 1)])
    assert [(r["punto_entrada"], r["indice_tiempo"]) for r in extras.month_gaps(f).collect()] == [("p", "2020-02")]


def test_quantile_classes_edges_go_low(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 9)] + [(None,)], "v double")
    got = {r["v"]: r["c"] for r in extras.quantile_classes(df, "v", extras.PRICE_CLASSES, "c").collect()}
    assert got[1.0] == "bajo" and got[8.0] == "muy_alto" and got[None] is None
    assert sorted(got.values(), key=str).count("bajo") == 2


def test_scenario_grid_covers_domains(spark):
    hist = spark.createDataFrame(
        [("a", "p", 1.0, 2020.0, 1.0, 10.0), ("b", "q", 3.0, 2020.0, 2.0, 20.0), ("a", "q", 5.0, 2021.0, 3.0, 30.0)],
        "pais_origen string, punto_entrada string, precio_promedio_usd double, `año` double, mes double, dias double")
    g = SC.grid(hist, ["precio_promedio_usd", "año", "mes", "dias"], ["pais_origen", "punto_entrada"],
                SC.Scenario(year=2024, month=7, price=99.0))
    rows = g.collect()
    assert sorted((r["pais_origen"], r["punto_entrada"]) for r in rows) == [("a", "p"), ("a", "q"), ("b", "p"), ("b", "q")]
    assert {(r["precio_promedio_usd"], r["año"], r["mes"], r["dias"]) for r in rows} == {(99.0, 2024.0, 7.0, 20.0)}
    one = SC.grid(hist, ["precio_promedio_usd"], ["pais_origen", "punto_entrada"],
                  SC.Scenario(year=2024, month=7, price=1.0, origin="b"))
    assert {r["pais_origen"] for r in one.collect()} == {"b"}


def test_demand_band_and_interval(spark):
    scored = spark.createDataFrame([("a", "p", 30.0), ("a", "q", 10.0), ("b", "p", 20.0)],
                                   "pais_origen string, punto_entrada string, prediction double")
    r = {x["pais_origen"]: x for x in SC.rollup(scored, 20.0, 100.0, 5.0).collect()}
    assert r["a"]["prediccion"] == 40.0 and r["a"]["rank"] == 1 and r["a"]["pct_total"] == 66.7
    assert r["a"]["demanda"] == "Demanda Muy Alta" and abs(r["a"]["intervalo_inf"] - (60 - 5 * 2 ** 0.5)) < 1e-9


def test_scenario_without_history_uses_defaults(spark):
    from arrivo.operators import scenario as SC

    rows = SC.grid(None, ["mes", "precio_promedio_usd", "variacion_usd_mensual", "dias"], ["pais_origen", "punto_entrada", "canal"],
                   SC.Scenario(2025, 7, 900.0), spark=spark).collect()
    assert len(rows) == 35 and {r.canal for r in rows} == {"Desconocido"}
    assert {(r.mes, r.precio_promedio_usd, r.variacion_usd_mensual, r.dias) for r in rows} == {(7.0, 900.0, 850.0, 0.0)}
