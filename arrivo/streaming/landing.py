"""S5 + S18 as a file stream: land only new files, tagged with their source file and run date."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def land_new_files(spark: SparkSession, source: str, schema: T.StructType | str, sink: str, checkpoint: str,
                   run_date: str, fmt: str = "parquet", partition_by=("run_date",),
                   max_files_per_trigger: int | None = None, file_glob: str | None = None) -> int:
    """Copy the files of ``source`` (a file, or a folder, files matching ``file_glob``) not landed before into ``sink``.

    Returns the rows landed by this run, counted in the sink.

    The parquet file sink commits each micro-batch through its own log, so a
    batch is landed exactly once.  The stream's checkpoint (``checkpoint``, a shared folder) records which
    files were processed, so a re-run lands nothing twice and a failed run
    resumes where it stopped.  ``availableNow`` processes what exists now and
    stops, like a scheduled batch.  Rows carry ``source_file`` (from the hidden
    file metadata) and ``run_date``; the sink is partitioned by run date.
    """
    def landed() -> int:
        try:
            return spark.read.parquet(sink).count()  # from the files' footers
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return 0

    folder = spark._jvm.org.apache.hadoop.fs.Path(source)
    if folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(folder).isFile():
        source, file_glob = folder.getParent().toString(), folder.getName()  # a stream reads folders
    before = landed()
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    stream = reader.load(source).select("*", F.col("_metadata.file_path").alias("source_file"),
                                        F.lit(run_date).alias("run_date"))
    q = (stream.writeStream.format("parquet")
         .option("path", sink)
         .option("checkpointLocation", checkpoint)
         .partitionBy(*partition_by)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return landed() - before
