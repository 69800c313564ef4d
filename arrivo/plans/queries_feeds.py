"""Driver queries for feeds of mixed shape."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivo.functions import parse_ts, safe_number
from arrivo.operators import clean
from arrivo.plans.queries import query
from arrivo.session import scratch_path
from arrivo.sources import feeds
from arrivo.sources import fixtures as fx

LIST_KEYS = 500  # order keys in one list document


def _documents(spark, d):
    """The daily quotes landed in three shapes, by order status, and the customers as a feed without the needed fields.

    ``F``: lists of records; ``O``: one object a document, date and price as texts; ``P``: other field names, an added
    field in every second record, no price in every seventh, and every 500th document cut short.
    """
    o = fx.table(spark, d, "orders")
    day, price, key = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_totalprice"), F.col("o_orderkey")
    listed = o.where("o_orderstatus = 'F'").groupBy(F.floor(key / LIST_KEYS)).agg(
        F.to_json(F.collect_list(F.struct(day.alias("fecha"), price.alias("venta")))).alias("value"))
    single = o.where("o_orderstatus = 'O'").select(F.to_json(F.struct(
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("Date"), price.cast("string").alias("Precio"))).alias("value"))
    changed = F.to_json(F.struct(
        day.alias("fecha_cotizacion"), F.when(key % 7 != 0, price).alias("sell"), F.when(key % 2 == 0, key).alias("nota")))
    changing = o.where("o_orderstatus = 'P'").select(
        F.when(key % 500 == 499, F.substring(changed, 1, 12)).otherwise(changed).alias("value"))
    other = fx.table(spark, d, "customer").select(F.to_json(F.struct("c_custkey", "c_name")).alias("value"))
    parts = {"listed": listed.select("value"), "single": single, "changing": changing, "other": other}
    return reduce(DataFrame.unionByName, [part.withColumn("feed", F.lit(name)) for name, part in parts.items()])


def _read(spark, d):
    path = scratch_path(spark, "feeds")
    _documents(spark, d).write.partitionBy("feed").text(path)
    return feeds.read_feeds(feeds.read_lines(spark, path), clean.QUOTE_ROLES)


_CUT = "o_orderstatus = 'P' AND o_orderkey % 500 = 499"


@query("mixed_feeds", f"""
SELECT CASE o_orderstatus WHEN 'F' THEN 'listed' WHEN 'O' THEN 'single' ELSE 'changing' END AS feed,
       CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS fecha,
       CASE WHEN o_orderstatus = 'P' AND o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS venta
FROM orders WHERE o_orderstatus IN ('F', 'O', 'P') AND NOT ({_CUT})""")
def q_mixed_feeds(spark, d):
    """S3 + U1 + C4: quotes from lists, single objects and records with changing fields, read once, roles by feed."""
    rows, _ = _read(spark, d)
    return rows.select("feed", parse_ts("fecha", day_first=True).alias("fecha"), safe_number("venta").alias("venta"))


@query("mixed_feed_report", f"""
SELECT CASE o_orderstatus WHEN 'F' THEN 'listed' WHEN 'O' THEN 'single' ELSE 'changing' END AS feed,
       CASE WHEN o_orderstatus = 'F' THEN count(DISTINCT o_orderkey // {LIST_KEYS}) ELSE count(*) END AS documents,
       count(*) FILTER ({_CUT}) AS bad_documents, count(*) FILTER (NOT ({_CUT})) AS records, 0::BIGINT AS other_values,
       CASE o_orderstatus WHEN 'F' THEN 'fecha,venta' WHEN 'O' THEN 'Date,Precio' ELSE 'fecha_cotizacion,nota,sell' END AS fields,
       '' AS missing
FROM orders WHERE o_orderstatus IN ('F', 'O', 'P') GROUP BY o_orderstatus
UNION ALL SELECT 'other', count(*), 0, count(*), 0, 'c_custkey,c_name', 'fecha,venta' FROM customer""")
def q_mixed_feed_report(spark, d):
    """C5 + S7: documents, records, fields and missing roles of each feed; the feed without the roles is skipped."""
    _, report = _read(spark, d)
    return report.select("feed", "documents", "bad_documents", "records", "other_values",
                         F.concat_ws(",", "fields").alias("fields"), F.concat_ws(",", "missing").alias("missing"))
