"""Mixing sources to target weights by weighted fair queueing (operator 9).

Size: words ``[^\\x20\\x09-\\x0D]+`` of the text. Sources share ``share`` times all words by their weights; a
target stops at ``most`` times its source's size and the excess goes to the others by weight until none is
above. Each source's documents are shuffled by a seeded hash and queued up to ``most`` times; a queued
document gets the virtual finish time (words of its source up to and including it) / (the source's target).
All queued documents are sorted by that time and taken while their words fit the budget (the sum of targets).

Cumulative sums never meet in one task: a source's documents fall into hash ranges, the whole queue into time
ranges of equal width (all sources advance at their target rate, so these hold nearly equal words); sums of
the ranges give each range its offset, and one window runs inside each range. Only the table of sources (one
row each) and the tables of range sums are windowed whole.

Edge cases: null text has size 0; a null source is a source of its own, ordered last; a source or table
without words has target 0 and nothing is taken; equal times are ordered by source, hash, identifier and
locator; repeated rows are separate documents; extra columns are not read and pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrivo.llm.common import WORD, col, located, stored

#: Documents in a range that one task sorts.
RANGE_ROWS = 100_000


def _running(order: list, by: list):
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """source, source_size, source_rows, weight, target. ``sizes``: source, size, one row per document."""
    table = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    table = stored(table.withColumn("weight", weight.cast("long")), "sources")
    cap = F.col("source_size") * most
    budget = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    rate, capped = 0.0, -1
    while True:  # each round reshares what the targets above their cap leave; the capped set only grows
        above = F.col("weight") * F.lit(rate) > cap
        n, used, left = table.agg(F.count_if(above), F.sum(F.when(above, cap).otherwise(0)),
                                  F.sum(F.when(above, 0).otherwise(F.col("weight")))).first()
        if n == capped or not left:
            break
        capped, rate = n, (budget - used) / left
    rise = F.col("weight") * F.lit(rate)
    return table.withColumn("target", F.when(rise > cap, cap.cast("double")).otherwise(rise))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(documents, queue). documents: doc_id, source, size, source_size, target, file, at, one row per row of ``docs``.

    queue: the taken copies: file, at, copy (0 to most - 1), finish, position (words taken before it).
    """
    docs, file, row = located(docs)
    thin = stored(docs.select(
        col(id_col).alias("doc_id"), col(source_col).alias("source"),
        F.coalesce(F.regexp_count(col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(col(id_col).cast("string"), F.lit("")))).alias("h"),
        file.alias("file"), row.alias("at")), "sizes")
    targets = stored(source_targets(thin, weights, share, most), "targets")
    total = targets.agg(F.sum("target"), F.sum("source_rows")).first()
    budget, rows = total[0] or 0.0, total[1] or 0

    parts = F.greatest(F.lit(1), F.ceil(F.col("source_rows") / RANGE_ROWS)).cast("long")
    known = (thin.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
             .withColumn("part", F.shiftright(F.conv(F.substring("h", 1, 8), 16, 10).cast("long") * parts, 32)).drop("s"))
    sums = known.groupBy("source", "part").agg(F.sum("size").alias("words"))
    offsets = sums.select(F.col("source").alias("s"), F.col("part").alias("p"),
                          (F.sum("words").over(_running(["part"], ["source"])) - F.col("words")).alias("before"))
    here = known.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    done = F.col("before") + F.sum("size").over(_running(["h", "doc_id", "file", "at"], ["source", "part"]))
    queued = (here.where("target > 0").withColumn("done", done)
              .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
              .withColumn("finish", (F.col("done") + F.col("copy") * F.col("source_size")) / F.col("target")))

    ranges = max(1, most * rows // RANGE_ROWS)
    late = 2 * ranges + F.floor(ranges * (1 - 2 / F.col("finish")))
    queued = stored(queued.select(
        "file", "at", "copy", "finish", "size", "source", "h", "doc_id",
        F.when(F.col("finish") < 2, F.floor(F.col("finish") * ranges)).otherwise(late).cast("long").alias("span")), "queue")
    sums = queued.groupBy("span").agg(F.sum("size").alias("words"))
    offsets = sums.select("span", (F.sum("words").over(_running(["span"], [])) - F.col("words")).alias("before"))
    order = ["finish", F.col("source").asc_nulls_last(), "h", "doc_id", "file", "at", "copy"]
    taken = (queued.join(offsets.where(F.col("before") <= budget), "span")
             .withColumn("until", F.col("before") + F.sum("size").over(_running(order, ["span"])))
             .where(F.col("until") <= budget))
    documents = known.select("doc_id", "source", "size", "source_size", "target", "file", "at")
    return documents, taken.select("file", "at", "copy", "finish", "size", (F.col("until") - F.col("size")).alias("position"))


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """documents of :func:`mix` with ``taken``: the words that the mix takes of each, repeats counted."""
    documents, queue = mix(docs, **options)
    got = queue.groupBy("file", "at").agg(F.sum("size").alias("taken"))
    return documents.join(got, ["file", "at"], "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken."""
    docs, file, row = located(docs)
    queue = stored(mix(docs, **options)[1].select(F.col("file").alias("q_file"), F.col("at").alias("q_at")), "taken")
    # the queue grows with the documents, and its compressed files look smaller than it is: no broadcast
    joined = docs.join(queue.hint("merge"), (file == queue["q_file"]) & (row == queue["q_at"]))
    return joined.select([docs[f"`{c.replace('`', '``')}`"] for c in docs.columns])
