"""Points stored by day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from millrace.lineage import materialize
from millrace.operators.points import coalesce_ranges, cut_at_days, without_ranges
from millrace.sources.buckets import overwrite_partitions
from millrace.sources.order import POSITION
from millrace.sources.tables import write_points


class PointTable:
    """A Parquet table of points ``(keys..., ts_ms, values...)`` partitioned by day; writes rewrite touched days only."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = ("series_id",)):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)

    def exists(self) -> bool:
        try:
            self.spark.read.parquet(self.path)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
                return False
            raise
        return True

    def scan(self) -> DataFrame:
        """All points with their ``day``, a partition column."""
        stored = self.spark.read.parquet(self.path)
        return stored.withColumn("day", F.col("day").cast("long")).where("ts_ms is not null")

    def read(self) -> DataFrame:
        return self.scan().drop("day")

    def upsert(self, points: DataFrame, order_by: Sequence[str] = ()) -> None:
        """Write points; the last of one key and time wins (see :func:`millrace.operators.merge.last_write_wins`).

        Stored columns that ``points`` lacks become null; others are an error.
        """
        if self.exists():
            kinds = {f.name: f.dataType for f in self.read().schema}
            unknown = [c for c in points.columns if c not in kinds and c not in (*order_by, POSITION)]
            if unknown:
                raise ValueError(f"columns that the table does not have: {unknown}")
            for name, kind in kinds.items():
                value = F.col(name) if name in points.columns else F.lit(None)
                points = points.withColumn(name, value.cast(kind))
        write_points(points, self.path, self.keys, [*order_by] or [c for c in (POSITION,) if c in points.columns])

    def delete(self, ranges: DataFrame) -> list[int]:
        """Delete the points in ``ranges (keys..., inclusive_begin, exclusive_end)``; returns the days rewritten.

        Ranges are merged, cut at stored days and met by series and day. The driver learns the numbers of
        the stored days only.
        """
        if not self.exists():
            return []
        stored = self.scan()
        days = sorted(r[0] for r in stored.select("day").distinct().collect())
        if not days:
            return []
        cut = materialize(cut_at_days(coalesce_ranges(ranges, self.keys), days[0], days[-1]), "cuts")
        held = set(days)
        touched = sorted(r[0] for r in cut.select("day").distinct().collect() if r[0] in held)
        if touched:
            left = without_ranges(stored.where(F.col("day").isin(touched)), cut, self.keys)
            overwrite_partitions(left, self.path, "day", touched)
        return touched
