"""Streams of created and changed rows.

Two forms share one rule, contiguous windows ``(previous bound, now - offset]`` on
``last_updated_time``: polling a table (:class:`ChangeReader`), and Structured
Streaming over newly written files (:func:`file_stream`, :func:`run_stream`).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.lineage import materialize
from millrace.plans.filters import apply_filter, compile_filter
from millrace.sources.raw import raw_scan
from millrace.sources.tables import VersionedTable

# Polling defaults and limits in milliseconds.
INTERVAL_MS, INTERVAL_MIN_MS, INTERVAL_MAX_MS = 5_000, 500, 60_000
OFFSET_MS, OFFSET_MIN_MS, OFFSET_MAX_MS = 30_000, 500, 10 * 86_400_000
RAW_OFFSET_MS = 2_000

Source = Callable[[], DataFrame]
Lookups = Callable[[], Mapping[str, DataFrame]]


def _filtered(rows: DataFrame, filter: Mapping | None, lookups: Lookups | None) -> DataFrame:
    """``rows`` that meet the filter; keys that need another table read it from ``lookups``."""
    return apply_filter(rows, filter, lookups() if lookups else None) if filter else rows


def change_window(column: Column, after: int | None, until: int) -> Column:
    """``(after, until]``; without a lower bound everything up to ``until``."""
    test = column <= F.lit(until)
    return test if after is None else test & (column > F.lit(after))


@dataclass
class ChangeReader:
    """Polls a table for rows changed since the last poll.

    ``start_ms`` of 0 includes history; now or later takes new rows only (the start
    itself is included). Rows written later than ``offset_ms`` after their timestamp
    are missed, so the offset is the price of completeness. The bound is kept in
    ``bounds`` if given, so a restart goes on where the last committed poll ended.
    """

    source: Source
    filter: Mapping | None = None
    start_ms: int = 0
    end_ms: int | None = None
    offset_ms: int = OFFSET_MS
    interval_ms: int = INTERVAL_MS
    time_column: str = "last_updated_time"
    bounds: VersionedTable | None = None
    lookups: Lookups | None = None

    def __post_init__(self):
        if not OFFSET_MIN_MS <= self.offset_ms <= OFFSET_MAX_MS:
            raise ValueError("polling offset must be between 0.5 seconds and 10 days")
        if not INTERVAL_MIN_MS <= self.interval_ms <= INTERVAL_MAX_MS:
            raise ValueError("polling interval must be between 0.5 and 60 seconds")
        if self.end_ms is not None and self.end_ms < self.start_ms:
            raise ValueError("end lies before start")
        self._bound: int = self.start_ms - 1
        self._stopped = False
        if self.bounds is not None and self.bounds.exists():
            self._bound = self.bounds.read().first()[0]

    @property
    def bound(self) -> int:
        return self._bound

    def window(self, now_ms: int) -> tuple[int, int]:
        until = now_ms - self.offset_ms
        if self.end_ms is not None:
            until = min(until, self.end_ms)
        return self._bound, max(until, self._bound)

    def poll(self, now_ms: int | None = None) -> DataFrame:
        """Rows of the next window; does not move the bound."""
        after, until = self.window(int(time.time() * 1000) if now_ms is None else now_ms)
        rows = self.source().where(change_window(F.col(self.time_column), after, until))
        return _filtered(rows, self.filter, self.lookups)

    def advance(self, now_ms: int) -> None:
        before, self._bound = self._bound, self.window(now_ms)[1]
        if self.bounds is not None and self._bound != before:
            self.bounds.commit(self.source().sparkSession.range(1).select(F.lit(self._bound).cast("long").alias("bound")))

    def finished(self) -> bool:
        return self._stopped or (self.end_ms is not None and self._bound >= self.end_ms)

    def abort(self) -> None:
        self._stopped = True

    def run(self, consumer: Callable[[DataFrame], None], clock: Callable[[], int] | None = None,
            sleep: Callable[[float], None] = time.sleep) -> None:
        """Poll until the end time or :meth:`abort`; the consumer sees non-empty batches only.

        The bound moves after the consumer returns, so a failed batch comes again.
        """
        clock = clock or (lambda: int(time.time() * 1000))
        while not self.finished():
            now = clock()
            rows = materialize(self.poll(now), "poll")  # computed once for the test and the consumer
            if not rows.isEmpty():
                consumer(rows)
            self.advance(now)
            if not self.finished():
                sleep(self.interval_ms / 1000)


def raw_changes(rows: Source, db: str, table: str, **options) -> ChangeReader:
    """A reader of the changed rows of one staging table; they settle sooner than other resources."""
    return ChangeReader(lambda: raw_scan(rows(), db, table), **{"offset_ms": RAW_OFFSET_MS, **options})


def file_stream(spark: SparkSession, path: str, schema: StructType, filter: Mapping | None = None,
                start_ms: int | None = None, end_ms: int | None = None,
                time_column: str = "last_updated_time", max_files: int | None = None) -> DataFrame:
    """A streaming frame over a folder (or glob) of Parquet files, filtered and bounded in time."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.parquet(path)
    if start_ms is not None:
        rows = rows.where(F.col(time_column) >= F.lit(start_ms))
    if end_ms is not None:
        rows = rows.where(F.col(time_column) <= F.lit(end_ms))
    return rows.where(compile_filter(filter)) if filter else rows


def run_stream(rows: DataFrame, consumer: Callable[[DataFrame, int], None], checkpoint: str,
               interval_ms: int | None = None, filter: Mapping | None = None, lookups: Lookups | None = None) -> StreamingQuery:
    """Hand every non-empty micro-batch to ``consumer(batch, batch_id)``.

    Without an interval everything available is processed and the query ends. ``filter`` may hold keys
    that need other tables; ``lookups`` is read anew for every batch.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        batch = _filtered(batch, filter, lookups)
        if not batch.isEmpty():
            consumer(batch, batch_id)

    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
    if interval_ms is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{interval_ms} milliseconds").start()
