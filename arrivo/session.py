"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of the engine relies on.  AQE re-plans joins from measured
# stage sizes (small monthly side tables become broadcasts at run time, hot keys
# are split by the skew-join rule); UTC keeps month keys stable.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "arrivo", conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's settings.

    ``master`` defaults to ``$ARRIVO_MASTER`` or ``local[*]``; on a cluster the
    launcher normally supplies it and this argument stays ``None``.
    """
    builder = SparkSession.builder.appName(app)
    master = master or os.environ.get("ARRIVO_MASTER")
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if master and master.startswith("local"):
        settings.setdefault("spark.sql.shuffle.partitions", "8")
        settings.setdefault("spark.driver.memory", "8g")
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be configured (a shared file system path);
    only a local-mode session gets a private scratch folder when it is unset.
    """
    sc = spark.sparkContext
    path = (spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
            or (sc.getCheckpointDir() or "").rsplit("/", 1)[0] or None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="arrivo-ckpt-")  # found again through the context's checkpoint folder
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


_SCRATCH: dict[str, list[str]] = {}
_MEMOS: list[dict] = []


def memo() -> dict:
    """A dictionary for results that rest on scratch tables; keys are tuples that begin with the application's id.

    ``remove_scratch`` takes out what rests on the tables it deletes.
    """
    _MEMOS.append({})
    return _MEMOS[-1]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder, remembered for ``remove_scratch``."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/arrivo-{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables that this application made; for the end of a run, when no result reads them any more."""
    app = spark.sparkContext.applicationId
    for kept in _MEMOS:
        for key in [k for k in kept if k[0] == app]:
            del kept[key]
    paths = _SCRATCH.pop(app, [])
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    return len(paths)


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Compute ``df`` once into a parquet table in the shared checkpoint folder and read it back.

    Used where a small result of an expensive plan is read several times
    (the fact joined with quotes feeds the rows and two whole-table medians).
    Unlike ``checkpoint()``, which counts the rows and then recomputes the plan
    to write them, this is one job; the files survive the loss of an executor,
    and the read-back carries real file sizes, so later joins against it are
    planned from measured statistics.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
