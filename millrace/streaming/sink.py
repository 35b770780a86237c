"""Buffered upserts as a streaming sink, and streaming point aggregates."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.durations import parse_granularity
from millrace.operators.merge import UPDATE, MergeSpec, merge
from millrace.sources.buckets import BucketedTable
from millrace.sources.order import POSITION
from millrace.sources.tables import VersionedTable

# Flush interval default and limits in milliseconds.
FLUSH_MS, FLUSH_MIN_MS, FLUSH_MAX_MS = 10_000, 1_000, 3_600_000


class Sink(Protocol):
    def write(self, batch: DataFrame, batch_id: int) -> None: ...


@dataclass
class MergeSink:
    """Upserts each batch into a table; a replayed batch id changes nothing.

    A bucketed table is rewritten only where keys of the batch fall. Of rows that share a key the last by
    ``order_by`` counts, or in input order where the stream has a position; without either they must be equal.
    """

    table: BucketedTable | VersionedTable
    spec: MergeSpec
    mode: str = UPDATE
    order_by: Sequence[str] = ()

    def write(self, batch: DataFrame, batch_id: int) -> None:
        upsert = lambda before: merge(before, batch, self.spec, self.mode, self.order_by).drop("_change")
        self.table.rewrite(batch, upsert, batch.drop(*self.order_by, POSITION), batch_id)


def buffered_upload(rows: DataFrame, sink: Sink, checkpoint: str, interval_ms: int | None = FLUSH_MS,
                    on_upload: Callable[[DataFrame, int], None] | None = None,
                    on_error: Callable[[Exception], None] | None = None) -> StreamingQuery:
    """Write a stream to a sink, one upsert per flush.

    ``interval_ms=None`` drains what is there and ends. ``on_upload`` runs after each
    written batch; ``on_error`` is told of a failure before the query stops.
    """
    if interval_ms is not None and not FLUSH_MIN_MS <= interval_ms <= FLUSH_MAX_MS:
        raise ValueError("flush interval must be between 1 second and 60 minutes")

    def flush(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        try:
            sink.write(batch, batch_id)
            if on_upload is not None:
                on_upload(batch, batch_id)
        except Exception as problem:
            if on_error is not None:
                on_error(problem)
            raise

    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(flush)
    trigger = {"availableNow": True} if interval_ms is None else {"processingTime": f"{interval_ms} milliseconds"}
    return writer.trigger(**trigger).start()


def stream_aggregates(points: DataFrame, granularity: str, lateness: str = "30 seconds",
                      keys: Sequence[str] = ("series_id",), event_time: str = "ts") -> DataFrame:
    """count, sum, min and max per series and window of a stream; late rows beyond the watermark drop."""
    g = parse_granularity(granularity)
    window: Column = F.window(F.col(event_time), f"{g.ms} milliseconds")
    grouped = points.withWatermark(event_time, lateness).groupBy(*keys, window.alias("_w"))
    v = F.col("value_num")
    return grouped.agg(
        F.count(v).alias("count"), F.sum(v).alias("sum"), F.min(v).alias("min"), F.max(v).alias("max")
    ).select(*keys, F.unix_millis(F.col("_w.start")).alias("window_start"), "count", "sum", "min", "max")
