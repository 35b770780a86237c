"""Cutting lineage through shared storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    ``spark.checkpoint.dir`` names it. A local session that has none set gets a
    fresh temporary folder; on a cluster that would be a machine-local folder, so
    the setting is required there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="millrace-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    The result has no upstream lineage, survives lost executors, is computed once,
    and carries real size statistics for the join planner.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_counted(df: DataFrame, condition: Column, label: str = "stage") -> tuple[DataFrame, int]:
    """As :func:`materialize`, plus the number of rows that meet ``condition``, from the same job."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.when(condition, 1)).alias("n"))
    return materialize(counted, label), seen.get["n"]
