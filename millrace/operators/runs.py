"""Ingestion-run tables: latest status per feed, heartbeat gaps, job details."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions.durations import HOUR_MS
from millrace.operators.points import with_neighbours

# Bounds of the heartbeat interval in milliseconds.
HEARTBEAT_DEFAULT_MS, HEARTBEAT_MIN_MS, HEARTBEAT_MAX_MS = 60_000, 10_000, 3_600_000


def latest_status(runs: DataFrame, key: str = "external_id") -> DataFrame:
    """``(key, last_success, last_failure, last_seen, last_message)`` per feed."""
    created, status = F.col("created_time"), F.col("status")
    at = lambda s: F.max(F.when(status == s, created))
    return runs.groupBy(key).agg(
        at("success").alias("last_success"), at("failure").alias("last_failure"), at("seen").alias("last_seen"),
        F.max_by("message", F.when(F.col("message").isNotNull(), created)).alias("last_message"),
    )


def with_latest_status(feeds: DataFrame, runs: DataFrame, key: str = "external_id") -> DataFrame:
    return feeds.join(latest_status(runs, key), key, "left")


def run_gaps(runs: DataFrame, interval_ms: int = HEARTBEAT_DEFAULT_MS, key: str = "external_id",
             status: str | None = "seen") -> DataFrame:
    """``(key, gap_start, gap_end, gap_ms)`` where two heartbeats are further apart than the interval."""
    if not HEARTBEAT_MIN_MS <= interval_ms <= HEARTBEAT_MAX_MS:
        raise ValueError("heartbeat interval must be between 10 seconds and 60 minutes")
    beats = runs if status is None else runs.where(F.col("status") == status)
    beats = beats.select(key, F.col("created_time").alias("ts_ms")).distinct()
    near = with_neighbours(beats, [key], carry=(), chunk_ms=HOUR_MS)
    gap = F.col("ts_ms") - F.col("prev_ts_ms")
    return near.where(gap > interval_ms).select(
        key, F.col("prev_ts_ms").alias("gap_start"), F.col("ts_ms").alias("gap_end"), gap.alias("gap_ms")
    )


def with_job_details(transformations: DataFrame, jobs: DataFrame) -> DataFrame:
    """Transformations with their running job and their last finished job."""
    running = F.col("status") == "Running"
    per = jobs.groupBy("transformation_id").agg(
        F.max_by("job_id", F.when(running, F.col("created_time"))).alias("running_job_id"),
        F.max_by("job_id", F.when(~running, F.col("created_time"))).alias("last_job_id"),
        F.max_by("status", F.when(~running, F.col("created_time"))).alias("last_job_status"),
    )
    return transformations.join(per, transformations["id"] == per["transformation_id"], "left").drop("transformation_id")


def latest_metrics(metrics: DataFrame) -> DataFrame:
    """Last count of each metric per job."""
    return metrics.groupBy("job_id", "name").agg(
        F.max("timestamp").alias("timestamp"), F.max_by("count", "timestamp").alias("count")
    )
