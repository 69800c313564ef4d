"""Source catalogue, readers, landing manifest and writers.

The catalogue is configuration: one row per source, a handful of rows.  It is
joined to data by key; data never passes through the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATALOG_SCHEMA = T.StructType([
    T.StructField("src", T.StringType(), False),
    T.StructField("dataset_name", T.StringType(), True),
    T.StructField("path", T.StringType(), True),
    T.StructField("type", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("frequency", T.StringType(), True),
    T.StructField("punto_entrada", T.StringType(), True),
    T.StructField("min_bytes", T.LongType(), True),
    T.StructField("enabled", T.BooleanType(), True),
])

# Defaults of the reference configuration.
DEFAULTS = {
    "min_bytes": 2000,
    "frequency": "trimestral",
    "category": "turismo",
    "enabled": True,
    "start_date": "2014-01-01",
    "min_rows_per_table": 3,
}


@dataclass
class SourceSpec:
    src: str
    path: str | None = None
    frequency: str | None = None
    punto_entrada: str | None = None
    category: str | None = None
    dataset_name: str | None = None
    type: str | None = "direct_csv"
    min_bytes: int | None = None
    enabled: bool | None = None


def catalog(spark: SparkSession, specs: list[SourceSpec]) -> DataFrame:
    """The catalogue as a DataFrame with defaults filled; disabled or path-less sources dropped.

    Built as a SQL ``VALUES`` relation (no Python-to-JVM data transfer), whose
    exact size Spark knows when it chooses the join.
    """
    def sql_lit(v, t) -> str:
        if v is None:
            return f"CAST(NULL AS {t.simpleString()})"
        if isinstance(v, bool):
            return "true" if v else "false"
        if isinstance(v, (int, float)):
            return f"CAST({v} AS {t.simpleString()})"
        return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"

    fields = CATALOG_SCHEMA.fields
    rows = ["(" + ", ".join(sql_lit(getattr(s, f.name), f.dataType) for f in fields) + ")" for s in specs]
    names = ", ".join(f.name for f in fields)
    df = spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t({names})")
    return df.select(
        "src",
        F.coalesce("dataset_name", "src").alias("dataset_name"),
        "path",
        "type",
        F.coalesce("category", F.lit(DEFAULTS["category"])).alias("category"),
        F.coalesce("frequency", F.lit(DEFAULTS["frequency"])).alias("frequency"),
        "punto_entrada",
        F.coalesce("min_bytes", F.lit(DEFAULTS["min_bytes"]).cast("long")).alias("min_bytes"),
        F.coalesce("enabled", F.lit(DEFAULTS["enabled"])).alias("enabled"),
    ).filter(F.col("enabled") & F.col("path").isNotNull())


# ---------------------------------------------------------------- readers

def read_csv(spark: SparkSession, path, schema: T.StructType | str | None = None, sep: str = ",") -> DataFrame:
    """Header CSV, UTF-8.  Pass a schema in production; inference costs a pass."""
    r = spark.read.option("header", True).option("encoding", "UTF-8").option("sep", sep)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def read_json(spark: SparkSession, path, schema: T.StructType | str | None = None, multiline: bool = True) -> DataFrame:
    """S3: a JSON list of records, or one object as one row (``multiLine`` handles both)."""
    r = spark.read.option("multiLine", multiline)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_first(spark: SparkSession, paths: list[str], reader=None) -> DataFrame:
    """The first path that exists (full table, then sample); same schema expected.

    Only a missing path leads on to the next one; any other error is raised.
    """
    reader = reader or (lambda p: spark.read.parquet(p))
    for p in paths:
        try:
            return reader(p)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"none of {paths} exists")


# ---------------------------------------------------------------- manifest

def file_sizes(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """Landed tables under the folder ``root``: name, path, size in bytes and number of files.

    A table is one file or a folder of part files right under ``root``; sizes
    come from the binary-file source (contents not read).
    """
    root = root.rstrip("/")
    entry = F.regexp_extract("path", f".*/{re.escape(root.rsplit('/', 1)[-1])}/([^/]+)", 1)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
             .load(root).select(entry.alias("entry"), "length"))
    return files.groupBy("entry").agg(F.sum("length").alias("size"), F.count(F.lit(1)).alias("files")).select(
        base_name(F.col("entry")).alias("name"), F.concat(F.lit(f"{root}/"), "entry").alias("path"), "size", "files")


def input_state(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Number, total size and last change of the files under ``path`` (a listing, nothing is read)."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(conf).listFiles(root, True)
    n = size = changed = 0
    while files.hasNext():
        f = files.next()
        n, size, changed = n + 1, size + f.getLen(), max(changed, f.getModificationTime())
    return n, size, changed


def base_name(path_col) -> F.Column:
    """File name without folder and extension: ``/x/raw/eti_a.csv`` -> ``eti_a``."""
    return F.regexp_extract(path_col, r"([^/]+?)(\.[^./]*)?$", 1)


def landing_manifest(files: DataFrame, cat: DataFrame, content: DataFrame) -> DataFrame:
    """S5 + S6: one row per catalogue source with size and status.

    A landed file at least ``min_bytes`` long is ``cached`` (already landed, no
    new download needed).  A shorter one is ``downloaded_small`` if it passes
    the small-file rule, else ``error`` without a path, like a missing one.
    ``content`` has a landed table's ``dataset_name``, ``records`` and
    ``n_columns``.  ``files`` is as from ``file_sizes``; a table belongs to the
    source whose ``dataset_name`` equals its name (an equi-join, so any number
    of tables is joined by hash, never pair by pair).
    """
    f = files.select(F.col("path").alias("file_path"), "size", F.col("name").alias("dataset_name"))
    joined = cat.drop("path").join(f, "dataset_name", "left").join(content, "dataset_name", "left")
    status = landing_status(F.col("size"), F.col("records"), F.col("n_columns"), F.col("min_bytes"))
    return joined.select("src", "dataset_name", F.when(status != "error", F.col("file_path")).alias("path"), "size", status.alias("status"),
                         "category", "frequency", "min_bytes", "records")


def landing_status(size, n_rows, n_cols, min_bytes) -> F.Column:
    """S5 + S6: ``cached``, ``downloaded_small`` or ``error`` of a landed table (``size`` NULL: not landed)."""
    return (F.when(size >= min_bytes, F.lit("cached"))
            .when(F.coalesce(small_file_rule(n_rows, n_cols, size, min_bytes), F.lit(False)), F.lit("downloaded_small"))
            .otherwise(F.lit("error")))


def small_file_rule(n_rows, n_cols, size, min_bytes):
    """A file under ``min_bytes`` is still accepted with rows > 0 and more than 2 columns."""
    return (size >= min_bytes) | ((n_rows > 0) & (n_cols > 2))


def rows_per_file(df: DataFrame) -> DataFrame:
    """Record count per input file via the hidden ``_metadata`` column (one aggregate, no loop)."""
    return df.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("records"))


def header_status(cols_col, keywords: list[str], small) -> F.Column:
    """``downloaded`` if any column name holds a keyword, else ``downloaded_uncertain``; small first."""
    kw = F.array(*[F.lit(k) for k in keywords])
    hit = F.exists(cols_col, lambda c: F.exists(kw, lambda k: F.lower(c).contains(k)))
    return (
        F.when(small, F.lit("downloaded_small"))
        .when(hit, F.lit("downloaded"))
        .otherwise(F.lit("downloaded_uncertain"))
    )


def success_count(manifest: DataFrame) -> DataFrame:
    """Files whose status starts with ``downloaded``."""
    return manifest.agg(F.count_if(F.col("status").startswith("downloaded")).alias("successful"))


def admitted(manifest: DataFrame, strict: bool = False) -> DataFrame:
    """C6 (one shared predicate, quirk Q4): ``downloaded*`` or ``cached`` with a path."""
    ok = F.col("status").startswith("downloaded")
    if not strict:
        ok = ok | (F.col("status") == "cached")
    return manifest.filter(ok & F.col("path").isNotNull())


# ---------------------------------------------------------------- writers

def write_partitioned(df: DataFrame, path: str, partition_cols=("category", "source"), fmt: str = "parquet",
                      mode: str = "overwrite") -> None:
    """One folder per partition value; dynamic overwrite replaces only the run's partitions."""
    w = df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


def write_sorted(df: DataFrame, path: str, keys=("indice_tiempo", "pais_origen", "punto_entrada"),
                 fmt: str = "parquet", partitions: int | None = None, sep: str = ";") -> None:
    """Range-partition on the keys and sort inside partitions: globally ordered files, no single task."""
    cols = list(keys)
    out = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    w = out.sortWithinPartitions(*cols).write.mode("overwrite")
    if fmt == "csv":
        w = w.option("header", True).option("sep", sep)
    w.format(fmt).save(path)


def write_json_doc(df: DataFrame, path: str) -> None:
    """A summary document (one-row DataFrame, nested structs allowed) as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)
