"""Logical input tables built from the driver's parquet tables.

The reference lands five arrival files (four quarterly, one monthly), a quote
feed and a search-interest series.  Those raw files are not public, so the
driver's TPC-H-like tables stand in for them (mapping in FIXTURES.md):

* arrivals: ``lineitem`` x ``orders`` x ``customer`` x ``nation`` with
  ``date(o_orderdate)`` as the day, ``n_name`` as the origin,
  ``o_orderpriority`` as the entry point / source, ``trunc(l_quantity) - 1``
  as visitors;
* quotes: ``orders`` (``casa = o_orderstatus``, ``fecha = o_orderdate``,
  ``venta = o_totalprice``);
* interest: ``lineitem`` (``fecha = l_shipdate``, ``interes_google = l_discount * 100``).

Everything here is lazy; nothing runs until an action.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Fixed values of the fixture mapping: which source codes are quarterly.
QUARTERLY_SOURCES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")
MONTHLY_SOURCES = ("5-LOW",)


_HANDLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table as a DataFrame handle, one per path and application.

    Opening a parquet path lists files and reads footers on the driver; the
    handle is reused so a plan that scans a table in several branches (and
    queries built one after another) pays that once.  Data is not cached.
    """
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    df = _HANDLES.get(key)
    if df is None:
        df = spark.read.parquet(path)
        _HANDLES[key] = df
    return df


def order_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visitors per order: ``sum(trunc(l_quantity) - 1)`` over its lines.

    Aggregating the line table by its join key before the join turns the
    largest input into one row per order; the aggregate's hash partitioning on
    ``l_orderkey`` is reused by the join with ``orders`` (no second exchange).
    """
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(F.col("l_quantity").cast("long") - F.lit(1)).alias("visitors"),
        F.count(F.lit(1)).alias("lines"),
    )


def order_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their origin name.

    The dimension chain is joined first (customer x nation: nation is a
    25-row table Spark broadcasts by its file size), so orders meet it in one
    join on ``custkey``; with the line aggregate on ``orderkey`` that makes two
    order-sized shuffles, the least two joins on different keys allow.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cn = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", "n_name")
    return (
        o.join(cn, o.o_custkey == cn.c_custkey)
        .select(
            "o_orderkey",
            F.col("o_orderdate").cast("date").alias("d"),
            F.col("n_name").alias("origin"),
            F.col("o_orderpriority").alias("gateway"),
        )
    )


def arrival_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-grain arrivals ``(d, origin, gateway, visitors)``; used where line counts matter."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        (F.col("l_quantity").cast("long") - F.lit(1)).alias("visitors"),
    )
    return order_origin(spark, sf_dir).join(li, "o_orderkey").drop("o_orderkey")


def arrivals_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-grain arrivals ``(d, origin, gateway, visitors, lines)``: same totals as the line grain."""
    return order_origin(spark, sf_dir).join(order_visitors(spark, sf_dir), "o_orderkey").drop("o_orderkey")


def landed_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed raw arrival files as one table with a ``src`` column.

    Quarterly sources hold one row per (quarter, country), the monthly source
    one per (month, country); column names follow the raw files
    (``periodo``, ``pais_residencia``, ``turistas_no_residentes``).
    """
    a = arrivals_by_order(spark, sf_dir)
    quarterly = F.col("gateway").isin(*QUARTERLY_SOURCES)
    period = F.when(quarterly, F.trunc("d", "quarter")).otherwise(F.trunc("d", "month"))
    return a.groupBy(
        F.col("gateway").alias("src"),
        period.alias("periodo"),
        F.col("origin").alias("pais_residencia"),
    ).agg(F.sum("visitors").alias("turistas_no_residentes"))


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw daily quote feed ``(casa, fecha, venta)``."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("casa"),
        F.col("o_orderdate").alias("fecha"),
        F.col("o_totalprice").alias("venta"),
    )


def interest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw search-interest series ``(fecha, interes_google)``."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("fecha"),
        (F.col("l_discount") * F.lit(100.0)).alias("interes_google"),
    )


def quality_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` left join ``labels``: quality/toxic are NULL where unlabelled."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", "left")
