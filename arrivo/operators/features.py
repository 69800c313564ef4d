"""Ordered split, folds and the feature pipeline (M1-M7, W5, Q-19, Q-20, Q-22).

The split and the folds are columns computed from the positional rank (W5),
so they need no row shuffling beyond the rank itself.  Pre-processing is a
``pyspark.ml.Pipeline``; the two steps Spark ML does not have in the needed
form (exact interpolated median fill, population-std scaling) are small
persistable stages whose fitted values are one aggregate over the train rows.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivo.functions import rint_round
from arrivo.operators.assemble import KEYS, positional_rank
from arrivo.operators.profile import DATE_DENY, numeric_columns, text_columns, to_long
from arrivo.operators.ranks import quantiles

TARGET = "turistas"


# ---------------------------------------------------------------- M1, M2, M9 (split, drift, folds)

def with_split(df: DataFrame, train_share: float = 0.8, keys=KEYS, n_folds: int = 5) -> DataFrame:
    """M1 + M9 + W5: ``pos`` (1-based order by keys), ``split`` (first ``int(0.8 n)`` rows train) and ``fold``.

    Folds are contiguous over the train rows in order, unshuffled, the first
    ``n_train % k`` folds one row larger (scikit-learn ``KFold``); test rows get
    fold NULL.  ``n`` is a scalar subquery; only the size of the largest month comes to the driver.
    """
    ranked = positional_rank(df, keys, "pos")
    n = df.agg(F.count(F.lit(1))).scalar()
    n_train = F.floor(n * F.lit(train_share)).cast("long")
    q = F.floor(n_train / F.lit(n_folds)).cast("long")
    rem = n_train - q * F.lit(n_folds)
    r = F.col("pos") - F.lit(1)
    big = rem * (q + F.lit(1))
    fold = F.when(r < big, F.floor(r / (q + F.lit(1)))).otherwise(rem + F.floor((r - big) / q)).cast("int")
    is_train = F.col("pos") <= n_train
    return ranked.withColumns({
        "split": F.when(is_train, F.lit("train")).otherwise(F.lit("test")),
        "fold": F.when(is_train, fold),
    })


def split_drift(split_df: DataFrame, target: str = TARGET) -> DataFrame:
    """M2: train and test means of the target, their percent difference and its band (10 / 20)."""
    g = split_df.agg(
        F.count_if(F.col("split") == "train").alias("n_train"),
        F.count_if(F.col("split") == "test").alias("n_test"),
        F.avg(F.when(F.col("split") == "train", F.col(target))).alias("media_train"),
        F.avg(F.when(F.col("split") == "test", F.col(target))).alias("media_test"),
    )
    diff = rint_round(F.try_divide(F.col("media_test") - F.col("media_train"), F.col("media_train")) * F.lit(100.0), 2)
    return g.select(
        "n_train", "n_test", rint_round("media_train", 4).alias("media_train"),
        rint_round("media_test", 4).alias("media_test"), diff.alias("diferencia_pct"),
        F.when(F.abs(diff) > 20, F.lit("alta")).when(F.abs(diff) > 10, F.lit("moderada")).otherwise(F.lit("baja"))
        .alias("deriva"),
    )


def target_stats(split_df: DataFrame, target: str = TARGET) -> DataFrame:
    """Q-22: target mean, std, min, max, median, q25, q75 per split (exact quantiles)."""
    t = F.col(target).cast("double")
    g = split_df.groupBy("split").agg(
        F.avg(t).alias("mean"), F.stddev_samp(t).alias("std"), F.min(t).alias("min"), F.max(t).alias("max"),
    ).join(quantiles(split_df, ["split"], target, [0.5, 0.25, 0.75]).select("split", F.col("q").alias("_q")), "split", "left")
    return g.select(
        "split", rint_round("mean", 4).alias("mean"), rint_round("std", 4).alias("std"), "min", "max",
        *[rint_round(F.element_at("_q", i + 1), 4).alias(n) for i, n in enumerate(("median", "q25", "q75"))],
    )


# ---------------------------------------------------------------- feature columns

def feature_columns(df: DataFrame, target: str = TARGET, deny=DATE_DENY, drop=("pos", "fold")) -> tuple[list[str], list[str]]:
    """Q-3 for modelling: numeric and categorical feature names (target, dates and helpers removed)."""
    excl = [target, *deny, *drop]
    return numeric_columns(df, exclude=excl), text_columns(df, exclude=[*excl, "split"])


def integrity(df: DataFrame, features: list[str], target: str = TARGET) -> DataFrame:
    """Q-19: per feature and target, nulls, zeros, min and max (numeric columns; one long-form aggregate)."""
    cols = [c for c in features if c in numeric_columns(df)] + [target]
    long = to_long(df, cols)
    return long.groupBy("columna").agg(
        F.count_if(F.col("v").isNull()).alias("nulos"), F.count_if(F.col("v") == 0).alias("ceros"),
        F.min("v").alias("min"), F.max("v").alias("max"))


# ---------------------------------------------------------------- M3, M4 persistable stages

class _HasValues(Params):
    values = Param(Params._dummy(), "values", "fitted value per input column", typeConverter=TypeConverters.toListFloat)


class MedianImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """M3: fill NULLs with the exact (interpolated) median of the fitting rows, per column.

    ``ml.feature.Imputer`` uses an approximate, non-interpolated quantile
    (2.0 instead of 2.5 for 1, 2, 3, 10).  The medians come from one rank
    selection over the stacked columns.
    """

    def __init__(self, inputCols=None):
        super().__init__()
        self._set(inputCols=list(inputCols or []))

    def _fit(self, df: DataFrame) -> "MedianImputerModel":
        cols = self.getInputCols()
        med = quantiles(to_long(df, cols), ["columna"], "v", [0.5])
        got = {r["columna"]: r["q"][0] for r in med.collect()}  # one value per column
        return MedianImputerModel(inputCols=cols, values=[float(got.get(c) if got.get(c) is not None else 0.0) for c in cols])


class MedianImputerModel(Model, HasInputCols, _HasValues, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, inputCols=None, values=None):
        super().__init__()
        self._set(inputCols=list(inputCols or []), values=list(values or []))

    def _transform(self, df: DataFrame) -> DataFrame:
        vals = self.getOrDefault(self.values)
        return df.withColumns({c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(v))
                               for c, v in zip(self.getInputCols(), vals)})


class PopulationScaler(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """M4: ``(x - mean) / std_pop`` per column; a constant column is only centred (scale 1).

    ``ml.feature.StandardScaler`` divides by the sample std; scikit-learn by
    the population std.
    """

    def __init__(self, inputCols=None):
        super().__init__()
        self._set(inputCols=list(inputCols or []))

    def _fit(self, df: DataFrame) -> "PopulationScalerModel":
        cols = self.getInputCols()
        st = to_long(df, cols).groupBy("columna").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s"))
        got = {r["columna"]: (r["m"], r["s"]) for r in st.collect()}  # two values per column
        means = [float(got[c][0] or 0.0) for c in cols]
        scales = [float(got[c][1]) if got[c][1] else 1.0 for c in cols]
        return PopulationScalerModel(inputCols=cols, values=means, scales=scales)


class PopulationScalerModel(Model, HasInputCols, _HasValues, DefaultParamsReadable, DefaultParamsWritable):
    scales = Param(Params._dummy(), "scales", "population std per input column", typeConverter=TypeConverters.toListFloat)

    def __init__(self, inputCols=None, values=None, scales=None):
        super().__init__()
        self._set(inputCols=list(inputCols or []), values=list(values or []), scales=list(scales or []))

    def _transform(self, df: DataFrame) -> DataFrame:
        m, s = self.getOrDefault(self.values), self.getOrDefault(self.scales)
        return df.withColumns({c: (F.col(f"`{c}`").cast("double") - F.lit(mu)) / F.lit(sd)
                               for c, mu, sd in zip(self.getInputCols(), m, s)})


# ---------------------------------------------------------------- M5-M7 pipeline

def preprocessing(numeric: list[str], categorical: list[str], output: str = "features") -> list:
    """M3-M7: median fill + population scaling for numbers; 'missing' fill + one-hot for categories.

    ``StringIndexer(handleInvalid='keep')`` gives unseen values the extra last
    index and ``OneHotEncoder(dropLast=True)`` drops exactly that slot, so an
    unknown category encodes as all zeros and no known level is dropped.
    """
    fill = ", ".join(f"coalesce(`{c}`, 'missing') AS `{c}__cat`" for c in categorical)
    stages = [
        SQLTransformer(statement=f"SELECT *, {fill} FROM __THIS__") if categorical else None,
        MedianImputer(inputCols=numeric),
        PopulationScaler(inputCols=numeric),
    ]
    if categorical:
        stages += [
            StringIndexer(inputCols=[f"{c}__cat" for c in categorical], outputCols=[f"{c}__idx" for c in categorical],
                          handleInvalid="keep", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=[f"{c}__idx" for c in categorical], outputCols=[f"{c}__vec" for c in categorical],
                          dropLast=True),
        ]
    stages.append(VectorAssembler(inputCols=numeric + [f"{c}__vec" for c in categorical], outputCol=output))
    return [s for s in stages if s is not None]


def preprocessing_pipeline(numeric: list[str], categorical: list[str]) -> Pipeline:
    return Pipeline(stages=preprocessing(numeric, categorical))


def nonfinite_report(df: DataFrame, col: str = "features") -> DataFrame:
    """Q-20: rows whose feature vector holds NaN or +-Inf, and the count of such cells."""
    arr = vector_to_array(F.col(col))
    bad = F.filter(arr, lambda x: F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return df.agg(F.count_if(F.size(bad) > 0).alias("filas_no_finitas"),
                  F.coalesce(F.sum(F.size(bad)), F.lit(0)).cast("long").alias("celdas_no_finitas"),
                  F.max(F.size(arr)).alias("ancho"))


def feature_names(pre: PipelineModel, numeric: list[str], categorical: list[str]) -> list[str]:
    """M5-M7: the names of the assembled vector's places: numbers, then ``column=level`` by column and sorted level."""
    indexer = [s for s in pre.stages if isinstance(s, StringIndexerModel)]
    levels = [f"{c}={v}" for m in indexer for c, labels in zip(categorical, m.labelsArray) for v in labels]
    return [*numeric, *levels]


def encoded_long(pre: PipelineModel, df: DataFrame, numeric: list[str], categorical: list[str], keys) -> DataFrame:
    """M5-M7: the encoded rows as ``keys``, ``feature``, ``value``: every number and every level that a row has.

    A level that the fitting rows lack gives no row, as its places are all zero. The names are as many as the vector is wide.
    """
    names = F.array(*[F.lit(n) for n in feature_names(pre, numeric, categorical)])
    cells = pre.transform(df).select(*keys, F.posexplode(vector_to_array("features")).alias("_at", "value"))
    return cells.where((F.col("_at") < len(numeric)) | (F.col("value") != 0)).select(
        *keys, F.element_at(names, F.col("_at") + 1).alias("feature"), "value")
