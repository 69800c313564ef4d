"""Feeds of mixed shape."""

import pytest

from arrivo.operators.clean import QUOTE_ROLES, Role
from arrivo.sources import feeds

DOCS = [
    ("list", '[{"fecha": "2020-01-01", "venta": 1.5}, {"fecha": "2020-01-02", "venta": "2", "x": [1, {"y": 2}]}]'),
    ("list", "[]"),
    ("list", '[null, 7, "text", [1], {"fecha": "2020-01-03"}]'),
    ("one", '{"Date": "2020-02-01", "PRECIO": 3}'),
    ("one", '{"Date": null, "PRECIO": {"a": 1}}'),
    ("one", '{"Date": "a", "Date": "b"}'),
    ("one", '{"cut": '),
    ("one", ""),
    ("one", None),
    ("late", '{"fecha": "2020-03-01"}'),
    ("late", '{"fecha": "2020-03-02", "valor": 4, "venta": 5}'),
    ("lacks", '{"fecha": "2020-04-01", "importe": 1}'),
    ("bad", "no json"),
    (None, '{"date": "2020-05-01", "sell": 1e3}'),
    (None, '{"date": "2020-05-01", "sell": 1e3}'),
]


@pytest.fixture(scope="module")
def read(spark):
    docs = spark.createDataFrame([(f, v, 0, "c") for f, v in DOCS], "feed string, value string, first int, record string")
    return feeds.read_feeds(docs, QUOTE_ROLES)


def test_rows_of_all_shapes(read):
    got = sorted((r.feed or "", r.fecha or "", r.venta or "") for r in read[0].collect())
    assert got == sorted([
        ("list", "2020-01-01", "1.5"), ("list", "2020-01-02", "2"), ("list", "2020-01-03", ""),
        ("one", "2020-02-01", "3"), ("one", "", '{"a":1}'),
        ("late", "2020-03-01", ""), ("late", "2020-03-02", "4"),  # of two matching fields the first by code point
        ("", "2020-05-01", "1000.0"), ("", "2020-05-01", "1000.0")])


def test_report(read):
    got = {r.feed: r for r in read[1].collect()}
    count = {f: (r.documents, r.bad_documents, r.records, r.other_values) for f, r in got.items()}
    assert count == {"list": (3, 0, 3, 4), "one": (6, 4, 2, 0), "late": (2, 0, 2, 0), "lacks": (1, 0, 1, 0),
                     "bad": (1, 1, 0, 0), None: (2, 0, 2, 0)}
    assert {f: r.missing for f, r in got.items()} == {
        "list": [], "one": [], "late": [], "lacks": ["venta"], "bad": ["fecha", "venta"], None: []}
    assert got["list"].fields == ["fecha", "venta", "x"] and got["late"].fields == ["fecha", "valor", "venta"]


def test_empty_table(spark):
    rows, report = feeds.read_feeds(spark.createDataFrame([], "feed string, value string"), QUOTE_ROLES)
    assert rows.columns == ["feed", "fecha", "venta"] and rows.count() == report.count() == 0


def test_keyword_roles_and_last_match(spark):
    docs = spark.createDataFrame([("a", '{"Pais_1": "x", "pais_2": "y", "total_turistas": 9}')], "feed string, value string")
    roles = (Role("country", keywords=("pais",), policy="last"), Role("visitors", exact=("turistas",), keywords=("turistas",)))
    assert [tuple(r) for r in feeds.read_feeds(docs, roles)[0].collect()] == [("a", "y", "9")]


def test_long_document(spark):
    text = "[" + ",".join('{"fecha": "2020-01-01", "venta": %d}' % k for k in range(50_000)) + "]"
    rows, _ = feeds.read_feeds(spark.createDataFrame([("a", text)], "feed string, value string"), QUOTE_ROLES)
    assert rows.selectExpr("count(*)", "sum(venta)").first()[:] == (50_000, 50_000 * 49_999 / 2)


def test_plan_without_python(spark, read):
    plan = read[0]._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "ArrowEval" not in plan and "LocalTableScan" not in plan and "ExistingRDD" not in plan
