"""Date expressions: parsing, month key, month start."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Date forms beside ISO: two numbers then a year, a year first with other signs, and eight digits.
_NUMBERS_YEAR = r"^\s*(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})(.*)$"
_YEAR_FIRST = r"^\s*(\d{4})[/.](\d{1,2})[/.](\d{1,2})(.*)$"
_EIGHT_DIGITS = r"^\s*(\d{4})(\d{2})(\d{2})\s*$"


def iso_text(c, day_first: bool = False) -> Column:
    """A date text in one of the listed forms as ``yyyy-MM-dd`` plus its rest; other text unchanged.

    ``03/04/2014`` is read month first unless ``day_first``; a first (or
    second) number over 12 can only be the day.
    """
    s = _col(c).cast("string")

    def iso(pattern: str, year: int, month: Column, day: Column, rest: bool) -> Column:
        tail = [F.regexp_extract(s, pattern, 4)] if rest else []
        return F.concat(F.regexp_extract(s, pattern, year), F.lit("-"), F.lpad(month, 2, "0"), F.lit("-"), F.lpad(day, 2, "0"), *tail)

    a, b = (F.regexp_extract(s, _NUMBERS_YEAR, k) for k in (1, 2))
    first, second = (F.coalesce(x.try_cast("int"), F.lit(0)) for x in (a, b))
    a_is_day = ((first > 12) | F.lit(day_first)) & ~((second > 12) & F.lit(day_first))
    return (F.when(s.rlike(_NUMBERS_YEAR), iso(_NUMBERS_YEAR, 3, F.when(a_is_day, b).otherwise(a), F.when(a_is_day, a).otherwise(b), True))
            .when(s.rlike(_YEAR_FIRST), iso(_YEAR_FIRST, 1, F.regexp_extract(s, _YEAR_FIRST, 2), F.regexp_extract(s, _YEAR_FIRST, 3), True))
            .when(s.rlike(_EIGHT_DIGITS), iso(_EIGHT_DIGITS, 1, F.regexp_extract(s, _EIGHT_DIGITS, 2), F.regexp_extract(s, _EIGHT_DIGITS, 3), False))
            .otherwise(s))


def parse_ts(c, fmt: str | None = None, day_first: bool = False) -> Column:
    """Text to a zone-less timestamp; bad text gives NULL (``errors='coerce'``).

    Without ``fmt`` it accepts dates, ISO date-times and zone suffixes (a zone
    is converted to UTC) and the forms of ``iso_text`` through ``try_cast``,
    which returns NULL without raising; a pattern-based parse throws
    internally on every mismatch and is many times slower.  The result is
    ``TIMESTAMP_NTZ`` like the landed data.
    """
    s = _col(c).cast("string")
    if fmt:
        return F.try_to_timestamp(s, F.lit(fmt)).cast("timestamp_ntz")
    return iso_text(s, day_first).try_cast("timestamp").cast("timestamp_ntz")


def ts_of(df, name: str) -> Column:
    """Column ``name`` of ``df`` as ``TIMESTAMP_NTZ``: typed columns are cast, only text is parsed."""
    from pyspark.sql import types as T

    t = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(t, T.TimestampNTZType):
        return c
    if isinstance(t, (T.TimestampType, T.DateType)):
        return c.cast("timestamp_ntz")
    return parse_ts(c)


def month_key(c) -> Column:
    """``yyyy-MM`` text key of a date or timestamp."""
    return F.date_format(_col(c), "yyyy-MM")


def month_start(c) -> Column:
    """First day of the month as a DATE."""
    return F.trunc(_col(c).cast("date"), "month")


def normalise_month_key(c) -> Column:
    """T4: a 7-character key with a dash is kept; other text is parsed and re-keyed; bad gives NULL."""
    s = _col(c).cast("string")
    return F.when((F.length(s) == 7) & s.contains("-"), s).otherwise(month_key(parse_ts(s)))
