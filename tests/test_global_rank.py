"""The global rank where one month holds most rows, against a plain sort."""

import pytest
from pyspark.sql import functions as F

from arrivo.operators.assemble import positional_rank
from arrivo.operators.ranks import LIMIT, range_count, range_parts

KEYS = ["month", "origin", "point"]
SQL = """SELECT IF(id % 5 < 3, '2001-03', IF(id % 50 = 4, NULL, concat('2001-', lpad(id % 12, 2, '0')))) AS month,
                concat('o', id % 97) AS origin, concat('p', lpad(id, 6, '0')) AS point, id AS `a.b` FROM range({n})"""


def plain(rows):
    order = sorted(rows, key=lambda r: (r.month is not None, r.month or "", r.origin, r.point))
    return {r["a.b"]: k + 1 for k, r in enumerate(order)}


@pytest.mark.parametrize("limit", [1_000_000, 700])
def test_hot_month_against_a_plain_sort(spark, limit):
    df = spark.sql(SQL.format(n=9000)).repartition(5)
    got = positional_rank(df, KEYS, "pos", limit)
    assert got.columns == [*KEYS, "a.b", "pos"]
    assert {r["a.b"]: r.pos for r in got.collect()} == plain(df.collect())


def test_no_range_is_much_larger_than_the_limit(spark):
    df = spark.sql(SQL.format(n=20000)).withColumn("origin", F.lit("one")).withColumn("point", F.lit("one"))  # equal keys
    sizes = [r["count"] for r in range_parts(df, KEYS, 20000, 2000).groupBy("__part").count().collect()]
    assert sum(sizes) == 20000 and max(sizes) <= 2000 and len(sizes) > 10


def test_repeated_rows_and_an_empty_table(spark):
    df = spark.range(3000).select(F.lit("2001-01").alias("month"), F.lit("a").alias("origin"), F.lit("b").alias("point"))
    assert sorted(r.pos for r in positional_rank(df, KEYS, "pos", 100).collect()) == list(range(1, 3001))
    assert positional_rank(df.limit(0), KEYS).count() == 0


def test_a_small_limit_does_not_multiply_the_ranges(spark):
    df = spark.sql(SQL.format(n=9000)).repartition(5)
    sizes = [r["count"] for r in range_parts(df, KEYS, 9000, 10).groupBy("__part").count().collect()]
    assert sum(sizes) == 9000 and len(sizes) <= 256 and max(sizes) < 200
    assert {r["a.b"]: r.pos for r in positional_rank(df, KEYS, "pos", 10).collect()} == plain(df.collect())


def test_ranges_grow_no_faster_than_the_rows():
    assert [range_count(n, 10_000) for n in (1, 600_000, 3_600_000, 36_000_000, 216_000_000)] == [1, 240, 256, 256, 864]
    assert [range_count(n) for n in (0, 1, 10 * LIMIT, 1000 * LIMIT)] == [1, 1, 40, 4000]
    assert range_count(100 * LIMIT, 10 * LIMIT) == 40
