"""Exact order statistics on columns of any size (Q-1, Q-2, Q-6, Q-22, A15, D4, M3, M15, M19, W4).

``percentile`` keeps every distinct value of a group in one task's buffer. Here the values at the wanted ranks are
selected instead. Each rank has an open interval of values that it must lie in, at first all of them. A round sketches
the values inside the intervals (``percentile_approx``: a mergeable sketch of bounded size), takes the two of its
grid points around the rank as pivots, and counts exactly, in all partitions at once, how many values are below, at and
between the pivots. That settles the rank or leaves it in an interval some hundred times smaller, whatever the sketch's
errors. When no interval holds more than ``limit`` values, their distinct values are counted and ranked. Several groups
and ranks share every pass; the driver sees one number a round. Intervals are a row per group and rank: AQE
broadcasts them if they are small, and splits hot groups if they are not.

Null values are skipped; groups may be null; NaN is the largest value. Positions and interpolation are those of
``percentile``: rank p * (n - 1), linear between neighbours.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrivo.session import materialize, scratch_path

#: Values of a group that one task ranks.
LIMIT = 1_000_000
#: Points of the sketch's grid, and its accuracy.
GRID, ACCURACY = 500, 10_000


def _join(a: DataFrame, b: DataFrame, names: list[str]) -> DataFrame:
    """Inner join on equal names, null with null."""
    b = b.withColumnsRenamed({n: f"of_{n}" for n in names})
    same = reduce(lambda x, n: x & F.col(n).eqNullSafe(F.col(f"of_{n}")), names, F.lit(True))
    return a.join(b, same).drop(*[f"of_{n}" for n in names])


def _inside(rows: DataFrame, intervals: DataFrame, by: list[str]) -> DataFrame:
    """Each value once per interval (``by``, ``a``, ``b``) that it lies in, with the interval's columns."""
    inner = _join(rows, intervals, by)
    return inner.where((F.col("a").isNull() | (F.col("v") > F.col("a"))) & (F.col("b").isNull() | (F.col("v") < F.col("b"))))


def _round(rows: DataFrame, wide: DataFrame, by: list[str]) -> DataFrame:
    """One step of all ranks whose interval is still wide: new rows of ``by, rank, base, inside, a, b, value``."""
    sets = wide.select(*by, "a", "b").distinct()
    points = F.percentile_approx("v", F.array(*[F.lit(k / GRID) for k in range(GRID + 1)]), F.lit(ACCURACY))
    sketch = _inside(rows, sets, by).groupBy(*by, "a", "b").agg(points.alias("points"))
    place = F.floor((F.col("rank") - F.col("base")) / F.col("inside") * GRID).cast("int")
    pick = lambda k: F.element_at("points", F.least(F.greatest(k, F.lit(1)), F.lit(GRID + 1)))
    at = _join(wide, sketch, [*by, "a", "b"]).select(*by, "rank", "base", "inside", "a", "b", pick(place).alias("lo"), pick(place + 3).alias("hi"))
    at = materialize(at, "pivots")
    v = F.col("v")
    counts = _inside(rows, at, by).groupBy(*by, "rank").agg(
        F.count_if(v < F.col("lo")).alias("below"), F.count_if(v == F.col("lo")).alias("at_lo"),
        F.count_if((v > F.col("lo")) & (v < F.col("hi"))).alias("between"),
        F.count_if((v == F.col("hi")) & (v > F.col("lo"))).alias("at_hi"))
    z = _join(at, counts, [*by, "rank"])
    r = F.col("rank") - F.col("base")
    to_lo = F.col("below") + F.col("at_lo")
    to_hi = to_lo + F.col("between")
    beyond = to_hi + F.col("at_hi")
    case = lambda low, mid, high: F.when(r < F.col("below"), low).when(r < to_hi, mid).otherwise(high)
    return z.select(
        *by, "rank",
        (F.col("base") + case(F.lit(0), to_lo, beyond)).alias("base"),
        case(F.col("below"), F.col("between"), F.col("inside") - beyond).alias("inside"),
        case(F.col("a"), F.col("lo"), F.col("hi")).alias("a"), case(F.col("lo"), F.col("hi"), F.col("b")).alias("b"),
        F.when((r >= F.col("below")) & (r < to_lo), F.col("lo")).when((r >= to_hi) & (r < beyond), F.col("hi")).alias("value"))


def _place(p: float) -> Column:
    return F.lit(float(p)) * (F.col("n") - 1).cast("double")


def _between(p: float, low: Column, high: Column) -> Column:
    at, lower, upper = _place(p), F.floor(_place(p)), F.ceil(_place(p))
    return F.when((lower == upper) | (low == high), low).otherwise((upper - at) * low + (at - lower) * high)


def quantiles(df: DataFrame, by: list[str], value: str, ps: list[float], limit: int = LIMIT) -> DataFrame:
    """``by``, n (values that are not null), q (array of the quantiles ``ps``) of every group with a value.

    Counts the groups when called, to see whether rounds are needed.
    """
    named = [f"g{k}" for k in range(len(by))]
    rows = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(by, named)], F.col(f"`{value}`").cast("double").alias("v")).where("v IS NOT NULL")
    sizes = rows.groupBy(*named).agg(F.count("v").alias("n"))
    back = [F.col(n).alias(c) for c, n in zip(by, named)]
    if (sizes.agg(F.max("n")).first()[0] or 0) <= limit:
        return _small(rows, named, ps).select(*back, "n", "q")

    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(_place(p)), F.ceil(_place(p))) for p in ps])))
    state = sizes.where("n > 0").select(*named, F.explode(ranks).alias("rank"), F.lit(0).cast("long").alias("base"), F.col("n").alias("inside"),
                                        *[F.lit(None).cast("double").alias(c) for c in ("a", "b", "value")])
    state = materialize(state, "ranks")
    while (state.where("value IS NULL").agg(F.max("inside")).first()[0] or 0) > limit:
        wide = F.col("value").isNull() & (F.col("inside") > limit)
        state = materialize(state.where(~wide).unionByName(_round(rows, state.where(wide), named)), "ranks")
    left = state.where("value IS NULL")
    counts = _inside(rows, left, named).groupBy(*named, "rank", "base", "v").agg(F.count(F.lit(1)).alias("c"))
    until = F.sum("c").over(Window.partitionBy(*named, "rank").orderBy("v")) + F.col("base")
    settled = (counts.withColumn("until", until).where("until > rank").groupBy(*named, "rank").agg(F.min("v").alias("value")))
    values = (state.where("value IS NOT NULL").select(*named, "rank", "value").unionByName(settled)
              .groupBy(*named).agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("values")))  # two per quantile
    out = _join(sizes, values, named)
    own = lambda x: F.element_at("values", x)
    return out.select(*back, "n", F.array(*[_between(p, own(F.floor(_place(p))), own(F.ceil(_place(p)))) for p in ps]).alias("q"))


def _small(rows: DataFrame, by: list[str], ps: list[float]) -> DataFrame:
    """Groups of at most ``limit`` values: their distinct values are counted, then ranked."""
    counts = rows.groupBy(*by, "v").agg(F.count(F.lit(1)).alias("c"))
    group = Window.partitionBy(*by)
    z = counts.withColumns({"until": F.sum("c").over(group.orderBy("v")), "n": F.sum("c").over(group)})
    first = lambda rank: F.min(F.when(F.col("until") > rank, F.col("v")))
    z = z.groupBy(*by, "n").agg(*[f(x).alias(f"{s}{k}") for k, p in enumerate(ps)
                                  for s, f, x in (("lo", first, F.floor(_place(p))), ("hi", first, F.ceil(_place(p))))])
    return z.select(*by, "n", F.array(*[_between(p, F.col(f"lo{k}"), F.col(f"hi{k}")) for k, p in enumerate(ps)]).alias("q"))


# ---------------------------------------------------------------- W5

#: Parts that a sampled range partitioning makes for every ``LIMIT`` rows: its parts differ in size.
PARTS_PER_LIMIT = 4
#: Ranges up to which a limit below ``LIMIT`` is kept to.
FEW_RANGES = 256


def range_count(rows: int, limit: int = LIMIT) -> int:
    """Ranges for ``rows`` rows: none much over ``limit`` rows if few ranges do for that, else none over ``LIMIT``.

    Each range costs the driver a sample of some hundred keys and a task's result, and its rows only a sort that spills: a
    small limit must not multiply the ranges of a large table.
    """
    wanted = lambda most: -(-rows * PARTS_PER_LIMIT // most)
    return max(1, min(wanted(limit), FEW_RANGES), wanted(max(limit, LIMIT)))


def range_parts(df: DataFrame, keys: list[str], rows: int, limit: int = LIMIT) -> DataFrame:
    """``df`` written in the order of ``keys``, one sorted file per range; with ``__part`` and the row's place ``__at`` in it.

    Equal keys follow a hash of all columns, so a hot key is cut into several ranges, too; only rows that are equal in
    every column stay together. The files fix the ranges, which a second sampling could draw otherwise.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "ranged")
    order = [F.col(f"`{k}`") for k in keys]
    tie = F.xxhash64(*[F.col(f"`{c}`") for c, t in df.dtypes if not t.startswith("map")] or [F.lit(0)])
    ranged = (df.withColumn("__tie", tie).repartitionByRange(range_count(rows, limit), *order, "__tie")
              .sortWithinPartitions(*order, "__tie").drop("__tie").withColumn("__part", F.spark_partition_id()))
    ranged.write.option("maxRecordsPerFile", 0).parquet(path)
    return spark.read.schema(ranged.schema).parquet(path).withColumn("__at", F.col("_metadata.row_index"))


def rank_by_ranges(df: DataFrame, keys: list[str], name: str, rows: int, limit: int = LIMIT) -> DataFrame:
    """1-based global row number in the order of ``keys`` (nulls first), whatever the keys' distribution.

    A row's number is the count of rows in earlier files plus its place in its own: one exchange, no window over rows.
    The table of offsets has a row per file, so it is broadcast.
    """
    parts = range_parts(df, keys, rows, limit)
    sizes = parts.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select(F.col("__part").alias("__of"), before.alias("__before"))
    return (parts.join(F.broadcast(offsets), F.col("__part") == F.col("__of"))
            .select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__before") + F.col("__at") + 1).alias(name)))
