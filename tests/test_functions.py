"""Scalar expression builders against the hand-made cases."""

import math

from pyspark.sql import functions as F

from arrivo.functions import (clean_text, normalise_month_key, number_or_zero, parse_ts, rint_round, safe_number,
                              title_case, first_max_by, first_min_by)


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_title_case_matches_python(spark):
    for s in ["EE.UU, CANADÁ Y MÉXICO", "resto  américa", "o'neil-smith 2nd", "", "ÁÉÍ óú"]:
        assert one(spark, title_case("x"), s) == s.title()
    assert one(spark, clean_text("x"), "  EE.UU, CANADÁ Y MÉXICO ") == "Ee.Uu, Canadá Y México"
    assert one(spark, clean_text("x"), None) is None


def test_number_guard(spark):
    cases = {"12d": None, " 12 ": 12.0, "": None, "1,2": None, None: None, "-3.9": -3.9, "1e3": 1000.0, ".5": 0.5}
    for raw, want in cases.items():
        assert one(spark, safe_number("x"), raw) == want
    zero = {"12d": 0, " 12 ": 12, "": 0, "1,2": 0, None: 0, "-3.9": -3}
    for raw, want in zero.items():
        assert one(spark, number_or_zero("x"), raw) == want


def test_half_even_rounding(spark):
    assert one(spark, rint_round("x", 2), 0.125, "x double") == 0.12
    assert one(spark, rint_round("x", 2), 0.135, "x double") == round(0.135, 2)
    assert one(spark, rint_round("x", 1), 2.25, "x double") == 2.2


def test_parse_and_month_key(spark):
    import datetime as dt

    assert one(spark, parse_ts("x"), "2001-05-03") == dt.datetime(2001, 5, 3)
    assert one(spark, parse_ts("x"), "2001-05-03T10:00:00") == dt.datetime(2001, 5, 3, 10)
    assert one(spark, parse_ts("x"), "n/a") is None
    assert one(spark, normalise_month_key("x"), "2014-05") == "2014-05"
    assert one(spark, normalise_month_key("x"), "2014-05-17") == "2014-05"
    assert one(spark, normalise_month_key("x"), "junk") is None


def test_tie_safe_argmax(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 7.0), (3, 7.0), (4, None)], "k int, v double")
    r = df.agg(first_max_by("k", "v").alias("a"), first_min_by("k", "v").alias("b")).first()
    assert (r["a"], r["b"]) == (2, 1)
