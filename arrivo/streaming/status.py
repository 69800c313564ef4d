"""Landing with kept status (S5, S6, S13, S18): a file stream whose batches write facts about files, by batch id.

A landing folder (``home``, on shared storage) holds

* ``files/batch=N``  one row per arrived file: name of its table, path, size, run; records, columns and content of small files only;
* ``quarantine/run=R``  path and content of the files that a run rejects;
* ``progress``       the stream's checkpoint: which files were seen.

A batch that failed after its write runs again under the same number over the same files and replaces its rows, so no
file is counted twice. Decisions are taken from all rows kept so far, never from one batch, so a table whose part files
arrive in several batches or runs is judged as a whole. Files stay where they arrived; the status admits them. A file
stream sees a path once: a table that was rejected gets a new file under a new path (a part file in its folder).
"""

from __future__ import annotations

import io
import re

import pandas as pd
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivo.sources.catalog import base_name, small_file_rule

FACTS = "name string, path string, size long, changed timestamp, records long, n_columns int, content binary, run string"
SHAPE = "path string, content binary, records long, n_columns int"


def _shape(content: bytes, fmt: str) -> tuple[int | None, int | None]:
    """Records and columns of one small file; nothing for one that cannot be read."""
    try:
        if fmt == "parquet":
            meta = pq.read_metadata(io.BytesIO(content))
            return meta.num_rows, len(pq.read_schema(io.BytesIO(content)))
        table = pd.read_csv(io.BytesIO(content))
        return len(table), len(table.columns)
    except Exception:  # whatever a broken file raises: it has no records
        return None, None


def _shapes(small: DataFrame, fmt: str) -> DataFrame:
    def read(batches):
        for b in batches:
            got = [_shape(bytes(c), fmt) for c in b["content"]]
            yield pd.DataFrame({"path": b["path"], "content": b["content"], "records": pd.array([r for r, _ in got], "Int64"),
                                "n_columns": pd.array([n for _, n in got], "Int32")})

    return small.select("path", "content").mapInPandas(read, SHAPE)


def _write_facts(batch: DataFrame, batch_id: int, home: str, root: str, run: str, fmt: str, min_bytes: int) -> None:
    """The rows of one batch, replacing those of an earlier try."""
    spark = batch.sparkSession
    entry = F.regexp_extract("path", f".*/{re.escape(root.rsplit('/', 1)[-1])}/([^/]+)", 1)
    files = batch.select(base_name(entry).alias("name"), "path", F.col("length").alias("size"),
                         F.col("modificationTime").alias("changed"))
    # at most one trigger's paths; only files under the limit are opened
    small = [r.path for r in files.where(F.col("size") < min_bytes).select("path").collect()]
    if small:
        contents = spark.read.format("binaryFile").load(small)
        files = files.join(_shapes(contents, fmt), "path", "left")
    else:
        files = files.withColumns({"content": F.lit(None).cast("binary"), "records": F.lit(None).cast("long"),
                                   "n_columns": F.lit(None).cast("int")})
    (files.select("name", "path", "size", "changed", "records", "n_columns", "content", F.lit(run).alias("run"))
     .write.mode("overwrite").parquet(f"{home}/files/batch={batch_id}"))


def file_facts(spark: SparkSession, home: str) -> DataFrame:
    """The kept row of every arrived file."""
    try:
        return spark.read.schema(FACTS + ", batch long").parquet(f"{home}/files")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FACTS + ", batch long")  # nothing has arrived yet


def statuses(spark: SparkSession, home: str, cat: DataFrame, run: str) -> DataFrame:
    """One row per catalogue source: src, dataset_name, category, frequency, status, size, records, admitted.

    Runs are ordered by their label (a date). ``cached``: earlier runs landed at least ``min_bytes``.
    ``downloaded``: this run made it so, or the table is small but has records and more than two columns
    (a small table is taken anew by every run, as nothing valid is kept of it). ``error``: too small, or nothing arrived.
    """
    facts = file_facts(spark, home).where(F.col("run") <= run)
    tables = facts.groupBy(F.col("name").alias("dataset_name")).agg(
        F.sum("size").alias("landed"), F.sum(F.when(F.col("run") < run, F.col("size"))).alias("earlier"),
        F.sum("records").alias("records"), F.max("n_columns").alias("n_columns"))
    j = cat.join(tables, "dataset_name", "left")
    valid = F.coalesce(small_file_rule(F.col("records"), F.col("n_columns"), F.col("landed"), F.col("min_bytes")), F.lit(False))
    status = (F.when(F.coalesce(F.col("earlier") >= F.col("min_bytes"), F.lit(False)), "cached")
              .when(valid, "downloaded").otherwise("error"))
    ok = status != "error"
    return j.select("src", "dataset_name", "category", "frequency", status.alias("status"),
                    F.when(ok, F.col("landed")).otherwise(0).cast("long").alias("size"),
                    F.when(F.col("landed") < F.col("min_bytes"), F.col("records")).alias("records"), ok.alias("admitted"))


def land_with_status(spark: SparkSession, source: str, home: str, cat: DataFrame, run: str, fmt: str = "parquet",
                     file_glob: str | None = None, max_files: int = 1000) -> DataFrame:
    """Take in the files that are new in the folder ``source``, then return ``statuses`` of the run.

    ``cat`` is as from ``catalog.catalog``; a table (a file, or a folder of part files right under ``source``) belongs to the
    source whose ``dataset_name`` is its name. Files are opened only below the largest ``min_bytes`` of the catalogue.
    ``max_files`` bounds the files of a batch, and with it what the driver sees at once.
    """
    min_bytes = cat.agg(F.max("min_bytes")).first()[0] or 0
    root = source.rstrip("/")
    reader = (spark.readStream.format("binaryFile").option("recursiveFileLookup", True)
              .option("maxFilesPerTrigger", max_files))
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    schema = "path string, modificationTime timestamp, length long, content binary"
    stream = reader.schema(schema).load(root).select("path", "length", "modificationTime")  # contents are not read
    (stream.writeStream.foreachBatch(lambda b, n: _write_facts(b, n, home, root, run, fmt, min_bytes))
     .option("checkpointLocation", f"{home}/progress").trigger(availableNow=True).start().awaitTermination())
    out = statuses(spark, home, cat, run)
    _quarantine(spark, home, out, run, min_bytes)
    return out


def _quarantine(spark: SparkSession, home: str, status: DataFrame, run: str, min_bytes: int) -> None:
    """The rejected tables' files with their contents, each below ``min_bytes``; written anew when a run is repeated."""
    bad = status.where("NOT admitted").select(F.col("dataset_name").alias("name"))
    files = file_facts(spark, home).where((F.col("run") <= run) & (F.col("size") < min_bytes)).join(bad, "name", "left_semi")

    files.select("name", "path", "size", "content").write.mode("overwrite").parquet(f"{home}/quarantine/run={run}")
