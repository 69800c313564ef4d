"""Feeds whose JSON documents differ in shape (S3, S7, U1, C4, C5), read once as VARIANT.

A document is a list of records or one object (one record); fields may change from record to record. Every
document is parsed once, its records are written to the shared folder as VARIANT values, and the columns of
a feed are the fields found in any of its records, as they would be in a table read from it.

Edge cases: a document that is null, empty or no valid JSON (also an object that names a field twice) counts as
bad and gives no record; an empty list gives none either; null, numbers, texts and lists in the place of a
record count as other values. A feed that lacks a role is skipped and listed with what it lacks. The fields of
a JSON object have no order, so of several fields that match a role the first (or last) by code point is taken.
A null feed name is a feed of its own. A document must fit one VARIANT value, so large feeds are landed as many
documents (JSON lines); repeated documents are repeated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivo.operators.clean import Role
from arrivo.session import materialize


def read_lines(spark, path: str, schema: str = "value string, feed string") -> DataFrame:
    """A folder ``path`` with one folder ``feed=...`` for each feed, one document in a line."""
    return spark.read.schema(schema).text(path)


def records(docs: DataFrame, feed: str = "feed", text: str = "value") -> DataFrame:
    """``feed``, ``first`` (the row that stands for its document), ``bad`` and ``record`` (VARIANT), one row per value.

    A bad document and an empty list have one row without a record.
    """
    parsed = docs.select(F.col(feed).alias("feed"), F.try_parse_json(F.col(text)).alias("doc"))
    listed = F.coalesce(F.try_variant_get("doc", "$", "array<variant>"), F.array("doc"))
    return parsed.select("feed", F.col("doc").isNull().alias("bad"), F.posexplode_outer(listed).alias("at", "record")).select(
        "feed", (F.coalesce("at", F.lit(0)) == 0).alias("first"), "bad", "record")


def fields_of(record) -> Column:
    """The fields of one record as a map; NULL for a value that is no object."""
    return F.try_variant_get(record, "$", "map<string,variant>")


def field_of(names: Column, role: Role) -> Column:
    """C1-C4 on a sorted array of field names: the field for a role, or NULL."""
    exact = F.filter(names, lambda n: F.lower(n).isin(*role.exact))
    part = F.filter(names, lambda n: F.exists(F.array(*[F.lit(k) for k in role.keywords]).cast("array<string>"),
                                              lambda k: F.contains(F.lower(n), k)))
    hits = F.when(F.size(exact) > 0, exact).otherwise(part)
    return F.try_element_at(hits, F.lit(-1 if role.policy == "last" else 1))


def feed_report(found: DataFrame, roles) -> DataFrame:
    """One row per feed: documents, bad documents, records, other values, fields, the field of each role, roles it lacks.

    ``found`` is as from ``records``. Field names are counted before they are gathered, so one feed's rows never meet.
    """
    fields = fields_of("record")
    counts = found.groupBy("feed").agg(
        F.count_if("first").alias("documents"), F.count_if("bad").alias("bad_documents"),
        F.count(fields).alias("records"),
        F.count_if(fields.isNull() & F.col("record").isNotNull()).alias("other_values"))
    named = found.select("feed", F.explode(F.map_keys(fields)).alias("field")).distinct()
    names = named.groupBy(F.col("feed").alias("_feed")).agg(F.sort_array(F.collect_list("field")).alias("fields"))
    every = counts.join(names, F.col("feed").eqNullSafe(F.col("_feed")), "left").drop("_feed").withColumn(
        "fields", F.coalesce("fields", F.array().cast("array<string>")))
    picked = F.struct(*[field_of(F.col("fields"), r).alias(r.name) for r in roles])
    lacks = F.array_compact(F.array(*[F.when(F.col("picked")[r.name].isNull(), F.lit(r.name)) for r in roles]))
    return every.withColumn("picked", picked).withColumn("missing", lacks)


def read_feeds(docs: DataFrame, roles, feed: str = "feed", text: str = "value") -> tuple[DataFrame, DataFrame]:
    """U1 + C5: the rows of all feeds that have every role (``feed`` and one text column per role), and ``feed_report``."""
    found = materialize(records(docs, feed, text), "feed_records")
    report = feed_report(found, roles)
    usable = report.where(F.size("missing") == 0).select(F.col("feed").alias("_feed"), "picked")
    rows = found.select("feed", fields_of("record").alias("_record")).where(F.col("_record").isNotNull())
    rows = rows.join(usable, F.col("feed").eqNullSafe(F.col("_feed")))
    values = [F.try_variant_get(F.try_element_at("_record", F.col("picked")[r.name]), "$", "string").alias(r.name) for r in roles]
    return rows.select("feed", *values), report
