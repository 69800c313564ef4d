"""Connected components of a graph in a table, by alternating large and small stars (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivo.llm.common import stored


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def stars(links: DataFrame, a: str, b: str) -> DataFrame:
    """Columns ``hi``, ``lo``: each node of ``links`` that is not the least of its component, and that least node.

    Each round is two partial aggregations and two joins; a component never meets in one task, as joins on
    a hot centre are split. Rounds are written to the shared folder.
    """
    edges = stored(links.where(F.col(a) != F.col(b))
                   .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "links")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        low = both.groupBy("hi").agg(F.min("lo").alias("m")).select("hi", F.least("hi", "m").alias("m"))
        large = (both.join(low, "hi").where(F.col("lo") > F.col("hi"))
                 .select(F.col("lo").alias("hi"), F.col("m").alias("lo")).distinct())
        large = stored(large, "large-star")
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(low, "hi").where(F.col("lo") > F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .unionByName(low.select("hi", F.col("m").alias("lo"))).distinct())
        edges = stored(small, "small-star")
        if (now := _mark(edges)) == mark:
            break
        mark = now
    return edges
