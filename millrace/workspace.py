"""Resource tables with the verbs list, retrieve, aggregate, upsert, create, delete and stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators.merge import (
    SPECS, UPDATE, create_only, delete_keys, merge, resolve_ids, retrieve,
)
from millrace.operators.hierarchy import apply_sync, deleted_ids, sync_plan, upsert_assets
from millrace.operators.points import default_headers, in_window
from millrace.lineage import materialize
from millrace.plans.filters import apply_filter
from millrace.session import prepare
from millrace.sources.buckets import BUCKETS, BucketedTable
from millrace.sources.order import POSITION
from millrace.sources.points import PointTable
from millrace.sources.tables import parse_slice
from millrace.streaming.publisher import ChangeReader
from millrace.streaming.sink import FLUSH_MS, MergeSink, buffered_upload


class Resource:
    """One resource type of a workspace, stored in hash buckets of its key.

    Writes rewrite only the buckets in which changed keys fall.
    """

    def __init__(self, workspace: "Workspace", name: str):
        self.workspace = workspace
        self.name = name
        self.spec = SPECS[name]
        self.table = BucketedTable(workspace.spark, f"{workspace.root}/{name}", self.spec.keys, workspace.buckets)

    # ------------------------------------------------------------------ reading

    def list(self, filter: Mapping | None = None, limit: int | None = None, slice: str | None = None) -> DataFrame:
        """Rows that meet a filter; ``limit`` takes the first by key, ``slice`` is ``"i/n"``."""
        rows = self.table.read() if slice is None else self.table.slice(*parse_slice(slice))
        if filter:
            rows = apply_filter(rows, filter, self.workspace.lookups(filter))
        return rows if limit is None else rows.orderBy(*self.spec.keys).limit(limit)

    def retrieve(self, external_ids: Sequence[str] = (), ids: Sequence[int] = ()) -> DataFrame:
        items = [(e, None) for e in external_ids] + [(None, i) for i in ids]
        wanted = self.workspace.spark.createDataFrame(items, "external_id string, id long")
        if not ids and self.spec.keys == ("external_id",):
            return self.table.lookup(wanted)
        return retrieve(self.table.read(), wanted)

    def aggregate(self, filter: Mapping | None = None, field: str | None = None) -> DataFrame:
        """``(count)``, or ``(value, count)`` of a field."""
        rows = self.list(filter)
        count = F.count(F.lit(1)).alias("count")
        return rows.agg(count) if field is None else rows.groupBy(F.col(field).alias("value")).agg(count)

    # ------------------------------------------------------------------ writing

    def create(self, rows: DataFrame) -> None:
        self.table.rewrite(rows, lambda before: create_only(before, rows, self.spec.keys))

    def upsert(self, rows: DataFrame, mode: str = UPDATE, order_by: Sequence[str] = ()) -> None:
        """Update or replace. Of rows that share a key the last by ``order_by`` counts, or in input order where
        ``rows`` went through :func:`millrace.sources.order.with_position`; without either they must be equal.
        """
        if self.name == "assets":
            change = lambda before: upsert_assets(before, rows, mode)
        else:
            change = lambda before: merge(before, rows, self.spec, mode, order_by)
        self.table.rewrite(rows, lambda before: change(before).drop("_change"), rows.drop(*order_by, POSITION))

    def delete(self, external_ids: Sequence[str] | DataFrame, recursive: bool = False) -> None:
        """Delete by key; unknown keys are ignored. Assets may go with their subtrees."""
        wanted = external_ids
        if not isinstance(wanted, DataFrame):
            wanted = self.workspace.spark.createDataFrame([(e,) for e in external_ids], "external_id string")
        if self.name == "assets":
            wanted = materialize(deleted_ids(self.table.read(), wanted, recursive), "deleted")
        self.table.rewrite(wanted, lambda before: delete_keys(before, wanted, self.spec.keys)[0])

    def synchronize(self, rows: DataFrame, many: bool = False) -> DataFrame:
        """Make the stored hierarchies equal the given ones; returns the plan that was applied."""
        existing = self.table.read() if self.table.exists() else rows.limit(0)
        plan = materialize(sync_plan(rows, existing, many=many), "plan")
        edits = plan.where("change <> 'unchanged'")
        self.table.rewrite(edits, lambda before: apply_sync(rows, before, plan), rows)
        return plan

    # ---------------------------------------------------------------- streaming

    def stream(self, **options) -> ChangeReader:
        """A reader of created and changed rows (see :class:`ChangeReader`)."""
        wanted = options.get("filter") or {}
        return ChangeReader(self.table.read, **{"lookups": lambda: self.workspace.lookups(wanted), **options})

    def upload_queue(self, rows: DataFrame, checkpoint: str, interval_ms: int | None = FLUSH_MS,
                     mode: str = UPDATE, order_by: Sequence[str] = (), **hooks):
        """Upsert a stream into this resource, one merge per flush."""
        return buffered_upload(rows, MergeSink(self.table, self.spec, mode, order_by), checkpoint, interval_ms, **hooks)


class Datapoints:
    """Points of the workspace's time series, stored by day and keyed by external id and time.

    Series are named by ``external_id``, or by the internal ``id`` of a stored series; an id that no stored series
    has is an error. Series that get points but have no header yet are created with a default one.
    """

    def __init__(self, workspace: "Workspace"):
        self.workspace = workspace
        self.table = PointTable(workspace.spark, f"{workspace.root}/datapoints", ("external_id",))

    def _named(self, rows: DataFrame) -> DataFrame:
        """Rows with their external id in place of an internal one."""
        if "id" not in rows.columns:
            return rows
        if "external_id" not in rows.columns:
            rows = rows.withColumn("external_id", F.lit(None).cast("string"))
        headers = self.workspace.timeseries.table
        known = headers.read() if headers.exists() else self.workspace.spark.createDataFrame([], "id long, external_id string")
        if "id" in known.columns:
            rows = resolve_ids(rows, known.where("id is not null"))
        error = F.raise_error(F.concat(F.lit("unknown series id "), F.coalesce(F.col("id").cast("string"), F.lit("null"))))
        return rows.withColumn("external_id", F.when(
            F.col("external_id").isNull(), error.cast("string")).otherwise(F.col("external_id"))).drop("id")

    def upsert(self, points: DataFrame, order_by: Sequence[str] = ()) -> None:
        """Write points ``(external_id or id, ts_ms, value_num and / or value_string)``; the last of equal times wins
        (see :func:`millrace.operators.merge.last_write_wins`). Only the days of the points are rewritten.
        """
        named = materialize(self._named(points), "points")
        series = self.workspace.timeseries
        stored = series.table.read().select("external_id") if series.table.exists() else named.limit(0).select("external_id")
        for column, kind in (("value_num", "double"), ("value_string", "string")):
            if column not in named.columns:
                named = named.withColumn(column, F.lit(None).cast(kind))
        fresh = materialize(default_headers(named, stored), "headers")
        if not fresh.isEmpty():
            series.create(fresh)
        self.table.upsert(named.drop("is_step"), order_by)

    def list(self, start: int | None = None, end: int | None = None, external_ids: Sequence[str] | None = None) -> DataFrame:
        """Points of ``[start, end)``; the scan opens only the days of the window."""
        rows = in_window(self.table.scan(), start, end).drop("day")
        return rows if external_ids is None else rows.where(F.col("external_id").isin([*external_ids]))

    def delete(self, ranges: DataFrame) -> None:
        """Delete ``[inclusive_begin, exclusive_end)`` of series; only touched days are rewritten."""
        self.table.delete(materialize(self._named(ranges), "ranges"))


class Workspace:
    """The resource tables under one folder."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = prepare(spark)
        self.root = root.rstrip("/")
        self.buckets = buckets

    def __getattr__(self, name: str) -> Resource:
        if name not in SPECS:
            raise AttributeError(name)
        return Resource(self, name)

    @property
    def datapoints(self) -> Datapoints:
        return Datapoints(self)

    def lookups(self, filter: Mapping) -> dict[str, DataFrame]:
        """Tables that the join-based filter keys read."""
        found = {}
        if {"assetSubtreeIds", "rootAssetIds", "assetExternalIds"} & set(filter):
            found["assets"] = self.assets.table.read()
        if "dataSetIds" in filter and self.data_sets.table.exists():
            found["data_sets"] = self.data_sets.table.read()
        return found
