"""SQL transformations into resource tables with conflict modes, and their job log."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from millrace.lineage import materialize
from millrace.operators.hierarchy import apply_sync, sync_plan
from millrace.operators.merge import SPECS, UPDATE, MergeSpec, create_only, merge
from millrace.sources.tables import VersionedTable

CONFLICT_MODES = ("abort", "upsert", "update", "delete")

# Destination type to the resource whose merge rules apply.
DESTINATIONS = {
    "assets": "assets", "timeseries": "timeseries", "asset_hierarchy": "assets", "events": "events",
    "datapoints": "datapoints", "string_datapoints": "datapoints", "sequences": "sequences",
    "sequence_rows": "sequence_rows", "files": "files", "labels": "labels",
    "relationships": "relationships", "data_sets": "data_sets", "raw": "raw_rows",
}

JOBS_DDL = ("job_id string, transformation string, destination string, conflict_mode string, "
            "started_time bigint, finished_time bigint, status string, error string")
METRICS_DDL = "job_id string, timestamp bigint, name string, count bigint"


def destination_spec(kind: str) -> MergeSpec:
    if kind not in DESTINATIONS:
        raise ValueError(f"destination {kind!r} is not supported")
    return SPECS[DESTINATIONS[kind]]


def conform(rows: DataFrame, target: DataFrame) -> DataFrame:
    """Query output cast to the destination's columns; a column it lacks is an error."""
    extra = set(rows.columns) - set(target.columns)
    if extra:
        raise ValueError(f"destination has no column {sorted(extra)}")
    return rows.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in rows.columns])


def apply_rows(target: DataFrame, rows: DataFrame, kind: str, mode: str, ignore_nulls: bool = True,
               spec: MergeSpec | None = None) -> DataFrame:
    """The destination after the rows are applied: its columns plus ``_change``.

    abort inserts and fails on a known key; upsert merges; update touches known
    keys only; delete keeps the deleted rows, marked.
    """
    after = change_rows(target, rows, kind, mode, ignore_nulls, spec)
    return after.where(F.col("_change") != "deleted") if kind == "asset_hierarchy" and mode == "upsert" else after


def change_rows(target: DataFrame, rows: DataFrame, kind: str, mode: str, ignore_nulls: bool = True,
                spec: MergeSpec | None = None) -> DataFrame:
    """As :func:`apply_rows`; all deleted rows are kept, marked, so that they can be counted."""
    if mode not in CONFLICT_MODES:
        raise ValueError(f"conflict mode must be one of {CONFLICT_MODES}")
    spec = spec or destination_spec(kind)
    keys = list(spec.keys)
    rows = conform(rows, target)
    if kind == "asset_hierarchy" and mode == "upsert":
        # Written once: the merge, the deletes and the counts all read the same plan.
        plan = materialize(sync_plan(rows, target, many=True), "plan")
        after = apply_sync(rows, target, plan)
        marked = after.join(plan.select("external_id", "change"), "external_id", "left").select(
            *target.columns,
            F.when(F.col("change") == "new", "created").when(F.col("change") == "changed", "updated")
            .otherwise("untouched").alias("_change"),
        )
        gone = plan.where(F.col("change") == "deleted").select("external_id")
        return marked.unionByName(target.join(gone, "external_id", "left_semi").select(
            *target.columns, F.lit("deleted").alias("_change")))
    if mode == "abort":
        combined = create_only(target, rows, keys)
        known = target.select(*keys, F.lit("untouched").alias("_old"))
        return combined.join(known, keys, "left").select(
            *target.columns, F.coalesce("_old", F.lit("created")).alias("_change")
        )
    if mode == "delete":
        gone = rows.select(*keys).distinct().withColumn("_gone", F.lit(True))
        return target.join(gone, keys, "left").select(
            *target.columns, F.when(F.col("_gone"), "deleted").otherwise("untouched").alias("_change")
        )
    return merge(target, rows, spec, UPDATE, ignore_nulls=ignore_nulls,
                 only="update" if mode == "update" else None)


@dataclass
class JobResult:
    job_id: str
    status: str
    error: str | None
    metrics: dict[str, int]


class TransformationRunner:
    """Runs transformations into versioned tables and logs jobs and their metrics."""

    def __init__(self, spark: SparkSession, log_path: str):
        self.spark = spark
        self.jobs_path = f"{log_path.rstrip('/')}/jobs"
        self.metrics_path = f"{log_path.rstrip('/')}/metrics"

    def run(self, name: str, query: str | DataFrame, destination: VersionedTable, kind: str,
            mode: str = "upsert", ignore_nulls: bool = True) -> JobResult:
        job_id, started = uuid.uuid4().hex, int(time.time() * 1000)
        metrics: dict[str, int] = {}
        error = None
        try:
            rows = self.spark.sql(query) if isinstance(query, str) else query
            read, written = Observation(), Observation()
            rows = rows.observe(read, F.count(F.lit(1)).alias("read"))
            after = change_rows(destination.read(), rows, kind, mode, ignore_nulls)
            tally = lambda c: F.count(F.when(F.col("_change") == c, 1)).alias(c)
            after = after.observe(written, tally("created"), tally("updated"), tally("deleted"))
            destination.commit(after.where(F.col("_change") != "deleted").drop("_change"))
            metrics = {**read.get, **written.get}
        except Exception as problem:  # logged with the job, then reported to the caller
            error = str(problem)
        finished = int(time.time() * 1000)
        status = "Failed" if error else "Completed"
        job = [(job_id, name, kind, mode, started, finished, status, error)]
        self.spark.createDataFrame(job, JOBS_DDL).write.mode("append").parquet(self.jobs_path)
        lines = [(job_id, finished, k, int(v)) for k, v in metrics.items()]
        if lines:
            self.spark.createDataFrame(lines, METRICS_DDL).write.mode("append").parquet(self.metrics_path)
        return JobResult(job_id, status, error, metrics)

    def jobs(self) -> DataFrame:
        return self.spark.read.schema(JOBS_DDL).parquet(self.jobs_path)

    def metrics(self, job_id: str | None = None) -> DataFrame:
        found = self.spark.read.schema(METRICS_DDL).parquet(self.metrics_path)
        return found if job_id is None else found.where(F.col("job_id") == job_id)
