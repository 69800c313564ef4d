"""Aggregate expressions with pandas-compatible tie and precision rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_max_by(key, value) -> Column:
    """Key of the largest value; on ties the smallest key (pandas ``idxmax`` over a sorted index).

    Spark ``max_by`` keeps an arbitrary one of tied rows, so the ordering value
    is ``(-value, key)`` and the smallest is taken.  NULL values never win.
    """
    k, v = _col(key), _col(value)
    return F.min_by(k, F.when(v.isNotNull(), F.struct(F.negative(v), k)))


def first_min_by(key, value) -> Column:
    """Key of the smallest value; on ties the smallest key.  NULL values never win."""
    k, v = _col(key), _col(value)
    return F.min_by(k, F.when(v.isNotNull(), F.struct(v, k)))


def exact_median(c) -> Column:
    """Exact median with linear interpolation (pandas ``median``)."""
    return F.percentile(_col(c), F.lit(0.5))


def significant(c, digits: int = 12) -> Column:
    """Round to ``digits`` significant digits: takes off the last bits, which depend on the order of a sum."""
    x = _col(c).cast("double")
    places = F.lit(digits - 1) - F.floor(F.log10(F.abs(x))).cast("int")
    up, down = F.pow(F.lit(10.0), F.greatest(places, F.lit(0))), F.pow(F.lit(10.0), F.greatest(-places, F.lit(0)))
    return F.when((x == 0) | x.isNull(), x).otherwise(F.rint(x / down * up) / up * down)


def mean_of(c) -> Column:
    """Mean of the values as they are, to 12 significant digits, so that it does not depend on row order."""
    return significant(F.avg(_col(c).cast("double")))


def std_of(c) -> Column:
    """Sample standard deviation, to 12 significant digits; one value gives NULL."""
    return significant(F.stddev_samp(_col(c).cast("double")))


def correlation(x, y) -> Column:
    """Pearson correlation over the rows where both are present; NULL where one of them is constant there.

    ``corr`` divides by zero on a constant, which is an error in ANSI mode. The constant is told by its least and largest
    value: merged partial variances of equal values need not be exactly zero.
    """
    x, y = _col(x).cast("double"), _col(y).cast("double")
    px, py = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(px) * F.stddev_pop(py))
    return F.when((F.min(px) != F.max(px)) & (F.min(py) != F.max(py)), r)
