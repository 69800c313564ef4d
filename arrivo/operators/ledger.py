"""Finished fits of a parameter search, kept in a shared folder so that a later session goes on with the rest.

One small folder per fit, written and committed by Spark: fits of several threads do not share a committer, a fit
done again replaces its row, and a fit that was cut off while writing leaves no row. The number of fits is fixed by
the search (maps x folds), not by the data.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROW = "map string, fold int, rmse double, r2 double"


def run_key(train: DataFrame, columns: list[str], *settings) -> str:
    """Names the search: the rows (in any order) of ``columns`` and the settings that decide a fit's result.

    One aggregate; two sums of differently salted hashes, so a repeated row counts. Rows changed in any way are another run.
    """
    cells = [F.col(f"`{c}`") for c in columns]
    sums = [F.sum(F.xxhash64(F.lit(salt), F.struct(*[F.coalesce(c.cast("string"), F.lit("\0")) for c in cells])).cast("decimal(38,0)"))
            for salt in ("rows", "more")]
    row = train.agg(F.count(F.lit(1)), *sums).first()
    return hashlib.sha256(json.dumps([*map(str, row), columns, *settings]).encode()).hexdigest()[:24]


class Ledger:
    """The finished fits of one run under ``path``; a fit's key is its estimator (``model.effective``) and its fold."""

    def __init__(self, spark: SparkSession, path: str, run: str):
        self.spark, self.folder = spark, f"{path.rstrip('/')}/run={run}"

    @staticmethod
    def name(estimator: tuple) -> str:
        return hashlib.sha256(json.dumps(estimator).encode()).hexdigest()[:24]

    def rows(self) -> DataFrame:
        jvm, conf = self.spark._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(self.folder)
        if not folder.getFileSystem(conf).exists(folder):
            return self.spark.createDataFrame([], ROW)
        return self.spark.read.schema(ROW).option("recursiveFileLookup", True).parquet(self.folder)

    def done(self) -> dict[tuple[str, int], tuple[float, float]]:
        """Metrics by map and fold (at most maps x folds numbers)."""
        return {(r["map"], r["fold"]): (r["rmse"], r["r2"]) for r in self.rows().collect()}

    def add(self, name: str, fold: int, rmse: float, r2: float) -> None:
        row = self.spark.createDataFrame([(name, fold, rmse, r2)], ROW)
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/fit={name}-{fold}")
