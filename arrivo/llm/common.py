"""Helpers shared by the corpus operators: tables in the shared folder, packed rows, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from arrivo.session import scratch_path

#: Fixed value: the characters that part words (blank, and tab to carriage return).
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
#: Fixed value: a word, as a pattern for Java, RE2 and Python.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all machines share."""
    return scratch_path(spark, f"llm-{name}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def col(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that an operator's own names never clash with theirs."""
    return F.struct(*[col(c) for c in df.columns])


def located(docs: DataFrame) -> tuple[DataFrame, Column, Column]:
    """The table and its (file, row) locator; what is not a plain Parquet scan is written out first."""
    if docs._jdf.queryExecution().analyzed().children().isEmpty():
        try:
            meta = docs.metadataColumn("_metadata")
            docs.select(meta["file_path"], meta["row_index"])
            return docs, meta["file_path"], meta["row_index"]
        except AnalysisException:
            pass
    docs = stored(docs, "input")
    meta = docs.metadataColumn("_metadata")
    return docs, meta["file_path"], meta["row_index"]


def lower_ascii(text: Column) -> Column:
    """A-Z only to a-z; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def in_bytes(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each (a longer text comes alone)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def map_texts(df: DataFrame, keep: list[Column], text: Column, start: Callable[[], Callable[[pa.Array], list]],
              fields: list[StructField], limit: int = 4 << 20) -> DataFrame:
    """Columns ``keep`` plus the columns that a batch function makes of ``text``.

    ``start()`` runs once per task and returns the function; it gets a string array (slices of about
    ``limit`` bytes, whole texts) and returns one Arrow array per field, of the same length.
    """
    rows = df.select(*keep, text.cast("string").alias("__text"))
    at = len(keep)
    schema = StructType([*rows.schema.fields[:at], *fields])
    names = schema.names

    def run(batches):
        f = start()
        for batch in batches:
            for part in in_bytes(batch, at, limit):
                got = f(part.column(at))
                yield pa.RecordBatch.from_arrays([*part.columns[:at], *got], names=names)

    return rows.mapInArrow(run, schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit mixing of unsigned integers (Steele, Lea and Flood, SplitMix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
