"""Hourly states stored by day beside their points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions.durations import DAY_MS
from millrace.operators.rollups import aggregate_states, roll_up
from millrace.sources.buckets import overwrite_partitions
from millrace.sources.points import PointTable


class RollupTable:
    """A Parquet table of the states of a :class:`PointTable`, partitioned by day."""

    def __init__(self, spark: SparkSession, path: str, points: PointTable, step: Column | str | None = None):
        self.points = points
        self.step = step
        self._stored = PointTable(spark, path, points.keys)

    def refresh(self, days: Sequence[int] | None = None) -> list[int]:
        """Compute the states of ``days`` (all stored ones if null) anew; returns the days written.

        Only these days are read and rewritten; days that lost their points lose their states. Running it again
        changes nothing.
        """
        rows = self.points.scan()
        if days is None:
            # The driver learns the numbers of the days only.
            days = [r[0] for r in rows.select("day").distinct().collect()]
            if self._stored.exists():
                days += [r[0] for r in self._stored.scan().select("day").distinct().collect()]
        days = sorted(set(days))
        if days:
            states = roll_up(rows.where(F.col("day").isin(days)), self.points.keys, self.step)
            day = F.floor(F.col("ts_ms") / F.lit(DAY_MS)).cast("long")
            overwrite_partitions(states.withColumn("day", day), self._stored.path, "day", days)
        return days

    def read(self) -> DataFrame:
        """All states with their ``day``."""
        return self._stored.scan()

    def aggregate(self, granularity: str, aggregates: Sequence[str], start: int | str | None = None,
                  end: int | str | None = None, now_ms: int | None = None) -> DataFrame:
        return aggregate_states(self.read(), granularity, aggregates, start, end, self.points.keys, now_ms)
