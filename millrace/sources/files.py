"""File contents next to their metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators.merge import SPECS, last_write_wins, merge


def read_contents(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``(external_id, content, content_length, path)``; the file name is the external id."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return found.select(
        F.element_at(F.split("path", "/"), -1).alias("external_id"), "content",
        F.col("length").alias("content_length"), "path",
    )


def join_contents(contents: DataFrame, files: DataFrame) -> DataFrame:
    """Contents with metadata, found by external id, else by id; contents without metadata stay.

    Both arms are equi joins. ``contents`` holds ``external_id`` and, optionally, ``id``.
    """
    details = [c for c in files.columns if c not in ("external_id", "id")]
    by_external = files.select("external_id", F.struct(*files.columns).alias("_m1"))
    joined = contents.join(by_external, "external_id", "left")
    found = F.col("_m1")
    if "id" in contents.columns and "id" in files.columns:
        by_id = files.where(F.col("id").isNotNull()).select("id", F.struct(*files.columns).alias("_m2"))
        joined = joined.join(by_id, "id", "left")
        found = F.coalesce("_m1", "_m2")
    return joined.select(*contents.columns, found.isNotNull().alias("has_metadata"),
                         *[found[c].alias(c) for c in details if c not in contents.columns])


def upload(target: DataFrame, containers: DataFrame, order_by=()) -> DataFrame:
    """Write contents with metadata: one row per key, marked uploaded, with its length."""
    latest = last_write_wins(containers, ["external_id"], order_by)
    marked = latest.withColumn("uploaded", F.lit(True)).withColumn(
        "content_length", F.octet_length("content").cast("long")
    )
    return merge(target, marked, SPECS["files"])
