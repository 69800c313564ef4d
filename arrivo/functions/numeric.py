"""Numeric expressions: half-even rounding, guarded text-to-number, percent."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A plain decimal or scientific number with optional surrounding blanks.
# Spark's own cast accepts suffixes such as '12d' (a double literal); pandas
# and SQL engines reject them, so the text must pass this pattern first.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rint_round(c, digits: int = 2) -> Column:
    """Round half to even on the scaled double, like NumPy/pandas ``round``.

    Spark ``round`` is half-up and ``bround`` works on the decimal value; this
    form gives 0.12 for 0.125, as pandas does.
    """
    scale = float(10 ** digits)
    return F.rint(_col(c) * F.lit(scale)) / F.lit(scale)


def safe_number(c) -> Column:
    """Text or number to double; anything that is not a plain number is NULL."""
    x = _col(c)
    s = x.cast("string")
    return F.when(s.rlike(NUMBER_PATTERN), F.trim(s).try_cast("double"))


def num_of(df, name: str) -> Column:
    """Column ``name`` of ``df`` as double: numeric columns are cast, only text goes through the guard."""
    from pyspark.sql import types as T

    t = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(t, T.NumericType):
        return c.cast("double")
    return safe_number(c)


def number_or_zero(c) -> Column:
    """To number, truncate toward zero to a long; bad, missing or beyond a long to 0."""
    return F.coalesce(safe_number(c).try_cast("long"), F.lit(0).cast("long"))


def pct(num, den, digits: int | None = 2) -> Column:
    """Percent ``num/den*100``; a zero or NULL divisor gives NULL instead of an error."""
    v = F.try_divide(_col(num).cast("double"), _col(den).cast("double")) * F.lit(100.0)
    return rint_round(v, digits) if digits is not None else v
