"""Counters taken on the pass that does the work.

``observe`` puts the counts into the plan of the run's own write: the rows are not scanned again to count them. The
operators after the counters must not shuffle before the write (the catalogue is joined by broadcast, the quarter split is
an explode), so the counts come from the tasks whose output is committed, and a task that runs again is counted once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class RunCounters:
    """Counters of one run of ``clean.standardise_arrivals``; for one write, read after it."""

    def __init__(self):
        self._read, self._cleaned, self._out = (Observation(n) for n in ("read", "cleaned", "out"))

    def read(self, df: DataFrame) -> DataFrame:
        """Counts the rows that come in."""
        return df.observe(self._read, F.count(F.lit(1)).alias("rows_read"))

    def cleaned(self, df: DataFrame, number: Column, date: Column, floor: Column, value: Column) -> DataFrame:
        """Counts what cleaning loses; ``date`` below ``floor`` and missing dates are the rows filtered next."""
        stays = date.isNotNull() & (date >= floor)
        return df.observe(
            self._cleaned, F.count(F.lit(1)).alias("rows_of_known_sources"), F.count_if(number.isNull()).alias("bad_numbers"),
            F.count_if(date.isNull()).alias("bad_dates"), F.count_if(date < floor).alias("before_floor"),
            F.sum(F.when(stays, value)).alias("total_kept"))

    def expanded(self, df: DataFrame, value: str) -> DataFrame:
        """Counts the rows that go out and their total."""
        return df.observe(self._out, F.count(F.lit(1)).alias("rows_out"), F.sum(value).alias("total_out"))

    def values(self) -> dict[str, int]:
        """All counters, after the write; ``unknown_sources`` are rows without a catalogue entry, ``split_loss`` is Q1's."""
        v = {k: x or 0 for o in (self._read, self._cleaned, self._out) for k, x in o.get.items()}
        return v | {"unknown_sources": v["rows_read"] - v["rows_of_known_sources"], "split_loss": v["total_kept"] - v["total_out"]}

    def table(self, spark: SparkSession) -> DataFrame:
        """The counters as one row."""
        v = self.values()
        return spark.sql("SELECT " + ", ".join(f"CAST({int(x)} AS BIGINT) AS {k}" for k, x in sorted(v.items())))
