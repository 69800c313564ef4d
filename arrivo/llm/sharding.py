"""Shards of nearly equal bytes by histogram sort (operator 2).

A row's sort key is (hash of the text, hash of the identifier, hash of its place); its size is the text's UTF-8
bytes plus 16. Each boundary between shards has a target (its share of all bytes) and an interval of keys that
holds it. In each round every open boundary puts probes into its interval, all partitions count the exact
bytes and rows below all probes in one pass over the thin keys, and the intervals shrink to the probes around
the targets, until a probe meets the tolerance. Then all rows are exchanged once, by the ranges found.

Equal texts share the first part of the key, so a group stays together where a boundary between two texts lies
within ``group_tolerance`` of a shard's size; a larger group is cut by identifier. Shards larger than
``range_bytes`` are cut into several ranges, so one task sorts a range and not a shard; the exact counts give
each range's first slot.

Edge cases: null text has size 16 and crc32 0; null identifiers and repeated rows are rows like any other; an
empty table gives an empty result; extra columns are not read by name and pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from arrivo.llm.common import col, located, stored, whole_row

WIDTH = 20  # bytes of a key: 8 of the text, 8 of the identifier, 4 of the place
SPACE = 1 << 8 * WIDTH
TEXT = 1 << 8 * (WIDTH - 8)  # keys of one text
EXTRA = 16


def _key(text: Column, ident: Column, file: Column, row: Column) -> Column:
    hexed = lambda x: F.lpad(F.hex(x), 16, "0")
    return F.unhex(F.concat(hexed(F.xxhash64(text)), hexed(F.xxhash64(ident)), F.substring(hexed(F.xxhash64(file, row)), 9, 8)))


def _keys(column: pa.Array) -> np.ndarray:
    """Binary keys as numpy strings of fixed width; these compare like the bytes."""
    fixed = column.cast(pa.binary(WIDTH))
    if not len(fixed):
        return np.zeros(0, dtype=f"S{WIDTH}")
    return np.frombuffer(fixed.buffers()[1], dtype=f"S{WIDTH}", count=len(fixed), offset=fixed.offset * WIDTH)


def _packed(keys: list[int]) -> np.ndarray:
    return np.array([k.to_bytes(WIDTH, "big") for k in keys], dtype=f"S{WIDTH}")


def count_below(keys: DataFrame, probes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows with a key below each probe (ascending). ``keys``: key, size."""
    table = _packed(probes)

    def count(batches):
        size, rows = np.zeros(len(table) + 1), np.zeros(len(table) + 1, dtype=np.int64)
        for batch in batches:
            gap = np.searchsorted(table, _keys(batch.column(0)), side="right")
            size += np.bincount(gap, weights=batch.column(1).to_numpy(), minlength=len(size))
            rows += np.bincount(gap, minlength=len(rows))
        at = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(size[at].astype(np.int64)), pa.array(rows[at])],
                                         names=["gap", "size", "rows"])

    found = (keys.select("key", "size").mapInArrow(count, "gap int, size bigint, rows bigint")
             .groupBy("gap").agg(F.sum("size"), F.sum("rows")).collect())  # at most one row per probe
    size, rows = np.zeros(len(probes) + 1, dtype=np.int64), np.zeros(len(probes) + 1, dtype=np.int64)
    for gap, s, r in found:
        size[gap], rows[gap] = s, r
    return np.cumsum(size)[:-1], np.cumsum(rows)[:-1]


def splitters(keys: DataFrame, targets: list[float], tolerances: list[float], group_tolerance: float, total: tuple[int, int],
              probes_per_round: int = 8192) -> list[tuple[int, int, int]]:
    """For each target in bytes (ascending) a key with about that many bytes below it: (key, bytes, rows below)."""
    low = [(0, 0, 0)] * len(targets)
    high = [(SPACE, *total)] * len(targets)
    done: list[tuple[int, int, int] | None] = [None] * len(targets)
    first = True
    while any(d is None for d in done):
        opened = [k for k, d in enumerate(done) if d is None]
        each = probes_per_round if first else max(16, probes_per_round // len(opened))
        asked = {}
        for k in opened if not first else opened[:1]:
            a, b = low[k][0], high[k][0]
            unit = TEXT if b - a > TEXT else 1  # between texts as long as the interval holds several
            n = min(each, (b - a + unit - 1) // unit - 1)
            asked[k] = [a + (b - a) * (j + 1) // (n + 1) // unit * unit for j in range(n)]
        probes = sorted({p for own in asked.values() for p in own})
        size, rows = count_below(keys, probes) if probes else (np.zeros(0), np.zeros(0))
        first = False
        for k in opened:
            j = int(np.searchsorted(size, targets[k]))  # the first probe with at least the target below it
            if j < len(probes) and low[k][0] < probes[j] < high[k][0]:
                high[k] = (probes[j], int(size[j]), int(rows[j]))
            if j and low[k][0] < probes[j - 1] < high[k][0]:
                low[k] = (probes[j - 1], int(size[j - 1]), int(rows[j - 1]))
            best = min(low[k], high[k], key=lambda x: abs(x[1] - targets[k]))
            miss = abs(best[1] - targets[k])
            wide = high[k][0] - low[k][0]
            if miss <= tolerances[k] or wide <= 1 or high[k][2] - low[k][2] <= 1 or (wide <= TEXT and miss <= group_tolerance):
                done[k] = best
    return done


def shard(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", tolerance: float = 0.002,
          group_tolerance: float = 0.05, range_bytes: int = 256 << 20, keep: list[Column] | None = None) -> DataFrame:
    """``keep`` (default: row, all columns of ``docs``), doc_id, size, text_crc32, shard, slot.

    ``tolerance``: share of a shard's bytes by which a boundary may miss its target.
    """
    docs, file, row = located(docs)
    text, ident = col(text_col), col(id_col)
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + EXTRA).cast("long")
    key = _key(text, ident, file, row)
    keep = [whole_row(docs).alias("row")] if keep is None else keep
    rows = docs.select(*keep, ident.alias("doc_id"), size.alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
                       key.alias("key"))
    keys = stored(rows.select("key", "size"), "shard-keys")
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    each = total[0] / shards
    parts = max(1, int(np.ceil(each / range_bytes)))
    step = each / parts
    wanted = [step * k for k in range(1, shards * parts)]
    slack = [tolerance * each if k % parts == 0 else 0.1 * step for k in range(1, shards * parts)]
    found = splitters(keys, wanted, slack, group_tolerance * each, tuple(total)) if total[1] else []
    bounds = _packed([k for k, _, _ in found if k < SPACE])
    rows_before = np.array([0, *(r for _, _, r in found)], dtype=np.int64)
    ranges = np.arange(len(rows_before))
    first_slot = rows_before - rows_before[ranges // parts * parts]  # of each range in its shard

    at = len(rows.columns) - 1
    schema = StructType([*rows.schema.fields, StructField("range", IntegerType()),
                         StructField("first_slot", LongType()), StructField("shard", IntegerType())])

    def place(batches):
        for batch in batches:
            own = np.searchsorted(bounds, _keys(batch.column(at)), side="right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32)), pa.array(first_slot[own]),
                                              pa.array((own // parts).astype(np.int32))], names=schema.names)

    nth = F.row_number().over(Window.partitionBy("range").orderBy("key"))
    return (rows.mapInArrow(place, schema).withColumn("slot", F.col("first_slot") + nth - 1)
            .drop("key", "range", "first_slot"))


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """The whole rows under ``path``, in a folder per shard (shard=0, shard=1, ...) with their slot."""
    shard(docs, **options).select("row.*", "slot", "shard").write.partitionBy("shard").parquet(path)
