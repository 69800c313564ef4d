"""Near duplicates by SimHash and multi-index hashing (operator 5).

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of ``width`` words (repeats included,
joined by blanks; a shorter text is one shingle), XXH64 with seed 42 of each; a bit is 1 if set in over
half the hashes. A text without a word has fingerprint zero.

Links: equal fingerprints meet first, so copies cost one row. Each distinct fingerprint is cut into two
segments of 32 bits. Two fingerprints within r bits either differ by at most ra bits in the first segment
or by at most r - 1 - ra in the second, so small Hamming balls around one segment's value find all of them:
the probes are looked up in a table of all segment values and the complete distance is verified. With j bits
flipped at most r - j bits differ in the other segment, so one of its r - j + 1 parts is equal and joins the
key; that keeps a segment value that many fingerprints share from meeting itself in all pairs. Flips only
set bits, so each pair is found from one side.

Edge cases: null text counts as empty; a null identifier is larger than any other, and a component of null
identifiers only has a null component_id; of repeated rows the first by locator stays; extra columns are not
read and pass through; an empty table gives an empty result. ``max_bits`` may be 0 to 3.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from arrivo.llm.common import col, located, map_texts, stored
from arrivo.llm.components import stars

SEED = 42
BLOCK = 1 << 16


def _hashes(text: str | None, width: int) -> np.ndarray:
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split() if text else []  # bytes split at exactly the six blanks
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) <= width:
        return np.array([xxh64_intdigest(b" ".join(words), SEED)], dtype=np.uint64)
    runs = zip(*[words[k:] for k in range(width)], strict=False)
    return np.fromiter((xxh64_intdigest(b" ".join(r), SEED) for r in runs), dtype=np.uint64, count=len(words) - width + 1)


def fingerprints(texts: list[str | None], width: int = 3) -> np.ndarray:
    """Fingerprint of each text, as signed 64-bit integers."""
    ones = np.zeros((len(texts), 64), dtype=np.int64)
    counts = np.zeros(len(texts), dtype=np.int64)
    for k, text in enumerate(texts):
        h = _hashes(text, width)
        counts[k] = len(h)
        for at in range(0, len(h), BLOCK):
            part = h[at:at + BLOCK].astype(">u8")
            ones[k] += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > counts[:, None], axis=1)
    return bits.view(">u8").reshape(-1).astype(np.uint64).view(np.int64)


def _part(segment: Column, k: int, parts: int) -> Column:
    """The k-th of ``parts`` nearly equal pieces of a 32-bit segment."""
    cuts = [32 * i // parts for i in range(parts + 1)]
    return F.shiftright(segment, cuts[k]).bitwiseAND(F.lit((1 << (cuts[k + 1] - cuts[k])) - 1))


def _radii(max_bits: int) -> tuple[int, int]:
    """Ball radii of the two segments; -1: the segment is not needed."""
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must be 0 to 3")
    return max_bits // 2, max_bits - 1 - max_bits // 2


def near_pairs(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Pairs x, y of different fingerprints (column ``fp``, distinct) at ``max_bits`` or fewer differing bits."""
    first, second = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    probes, table = [], []

    def lookups(kind: int, other: Column, parts: int):
        return lambda segment: F.array(*[F.xxhash64(F.lit(kind), F.lit(k), segment, _part(other, k, parts)) for k in range(parts)])

    def flipped(own: Column, keys):
        clear = F.filter(F.sequence(F.lit(0), F.lit(31)), lambda b: F.getbit(own, b) == 0)
        return F.flatten(F.transform(clear, lambda b: keys(own.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), b)))))

    for name, own, other, radius in ((0, first, second, _radii(max_bits)[0]), (1, second, first, _radii(max_bits)[1])):
        for flips in range(radius + 1):
            keys = lookups(2 * name + flips, other, max_bits - flips + 1)
            table.append(keys(own))
            probes.append(flipped(own, keys) if flips else keys(own))
    asked = prints.select(F.col("fp").alias("x"), F.explode(F.concat(*probes)).alias("key"))
    there = prints.select(F.col("fp").alias("y"), F.explode(F.concat(*table)).alias("key"))
    # both sides grow with the input; Spark takes an explode for as small as its input and might broadcast it
    return (asked.join(there.hint("merge"), "key")
            .where((F.col("x") != F.col("y")) & (F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= max_bits))
            .select("x", "y"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                   max_bits: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint, component_id, kept, and the locator (file, at)."""
    docs, file, row = located(docs)
    thin = stored(map_texts(docs, [col(id_col).alias("doc_id"), file.alias("file"), row.alias("at")], col(text_col),
                            lambda: lambda texts: [pa.array(fingerprints(texts.to_pylist(), width))],
                            [StructField("fp", LongType())]), "prints")
    prints = stored(thin.groupBy("fp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "file", "at")).alias("first")), "distinct-prints")
    links = near_pairs(prints.select("fp"), max_bits)
    roots = stars(links, "x", "y").select(F.col("hi").alias("fp"), F.col("lo").alias("root"))
    nodes = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    heads = nodes.groupBy("root").agg(F.min("first").alias("head"))
    label = nodes.select("fp", "root").join(heads, "root").select("fp", "head")
    return thin.join(label, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("head.doc_id").alias("component_id"),
        ((F.col("head.file") == F.col("file")) & (F.col("head.at") == F.col("at"))).alias("kept"), "file", "at")


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
              max_bits: int = 2) -> DataFrame:
    """One row of each group (the smallest identifier), with the columns of ``docs``."""
    docs, file, row = located(docs)
    dropped = stored(simhash_groups(docs, id_col, text_col, width, max_bits).where("not kept").select("file", "at"), "dropped")
    return docs.join(dropped, (file == dropped["file"]) & (row == dropped["at"]), "left_anti")
