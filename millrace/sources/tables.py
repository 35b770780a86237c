"""Scans, slices and versioned tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException


def scan_slice(df: DataFrame, key: str, index: int, count: int) -> DataFrame:
    """Slice ``index/count`` (1-based); all slices together are ``df``, none overlap."""
    if not 1 <= index <= count:
        raise ValueError(f"slice {index}/{count} does not exist")
    return df.where(F.pmod(F.xxhash64(key), F.lit(count)) == F.lit(index - 1))


def parse_slice(text: str) -> tuple[int, int]:
    index, _, count = text.partition("/")
    return int(index), int(count)


class VersionedTable:
    """A Parquet table rewritten as whole versions, so that it can be read while it is replaced.

    Every commit writes ``v=<n>`` and then appends one row to the ``commits`` table;
    readers take the highest committed version. A failed write leaves no commit row.
    One writer at a time is assumed. A ``batch_id`` makes a replayed commit a no-op.
    """

    COMMITS = "version bigint, batch_id bigint, committed_at timestamp"

    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str] = ()):
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_by = list(partition_by)

    def _commits(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(self.COMMITS).parquet(f"{self.path}/commits")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return None

    def version(self) -> int:
        commits = self._commits()
        if commits is None:
            return 0
        return commits.agg(F.max("version")).first()[0] or 0

    def has_batch(self, batch_id: int) -> bool:
        commits = self._commits()
        return commits is not None and not commits.where(F.col("batch_id") == batch_id).isEmpty()

    def read(self, version: int | None = None) -> DataFrame:
        number = version if version is not None else self.version()
        if not number:
            raise FileNotFoundError(f"no committed version under {self.path}")
        return self.spark.read.parquet(f"{self.path}/v={number}")

    def exists(self) -> bool:
        return self.version() > 0

    def commit(self, df: DataFrame, batch_id: int | None = None) -> int:
        """Write ``df`` as the next version; returns its number."""
        if batch_id is not None and self.has_batch(batch_id):
            return self.version()
        number = self.version() + 1
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(f"{self.path}/v={number}")
        row = self.spark.range(1).select(
            F.lit(number).cast("long").alias("version"), F.lit(batch_id).cast("long").alias("batch_id"),
            F.current_timestamp().alias("committed_at"),
        )
        row.write.mode("append").parquet(f"{self.path}/commits")
        return number


    def rewrite(self, changed: DataFrame, change: Callable[[DataFrame], DataFrame], like: DataFrame | None = None,
                batch_id: int | None = None) -> None:
        """Apply ``change`` to the whole table; where there is none it starts from no rows of ``like``."""
        if batch_id is not None and self.has_batch(batch_id):
            return
        before = self.read() if self.exists() else (like if like is not None else changed).limit(0)
        self.commit(change(before), batch_id)


def write_points(new: DataFrame, path: str, keys: Sequence[str] = ("series_id",),
                 order_by: Sequence[str] = ()) -> None:
    """Upsert points into day partitions: last write wins, untouched days stay as they are.

    Only the days of the new points are read and rewritten (dynamic partition
    overwrite). Running it again with the same points changes nothing.
    """
    from millrace.functions.durations import DAY_MS
    from millrace.lineage import materialize
    from millrace.operators.merge import last_write_wins

    spark = new.sparkSession
    day = F.floor(F.col("ts_ms") / F.lit(DAY_MS)).cast("long").alias("day")
    key = [*keys, "ts_ms"]
    latest = last_write_wins(new, key, order_by).drop(*[c for c in order_by if c not in key])
    latest = materialize(latest.select("*", day), "points")
    try:
        stored = spark.read.schema(latest.schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        merged = latest
    else:
        # Rows without a time stand for emptied days.
        touched = stored.where("ts_ms is not null").join(latest.select("day").distinct(), "day", "left_semi")
        merged = touched.join(latest.select(*key), key, "left_anti").unionByName(latest)
    # A rebalance sizes the tasks at run time: a busy day is split into as many as it needs.
    (
        merged.hint("rebalance", "day").sortWithinPartitions("day", *keys, "ts_ms")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    )
