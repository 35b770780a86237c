"""Keyed tables partitioned by a hash of the key, rewritten bucket by bucket."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.utils import AnalysisException

BUCKET = "_bucket"
BUCKETS = 16


def _missing(error: Exception) -> bool:
    return "PATH_NOT_FOUND" in str(error)


def overwrite_partitions(rows: DataFrame, path: str, column: str, touched: Sequence[int]) -> None:
    """Replace the partitions ``column`` in ``touched`` of a Parquet table by ``rows``; other files stay as they are.

    Dynamic overwrite replaces the partitions that occur in the output, so each touched partition also gets
    one row of nulls: one that lost all its rows is emptied too. Readers leave such rows out. The rows may be
    read from the same table, since files are exchanged when all tasks have ended. A rebalance sizes
    tasks at run time: a full partition is split into as many as it needs.
    """
    spark = rows.sparkSession
    kind = rows.schema[column].dataType
    blank = spark.createDataFrame([(int(t),) for t in touched], "_t long").select(
        *[F.lit(None).cast(f.dataType).alias(f.name) if f.name != column else F.col("_t").cast(kind).alias(column)
          for f in rows.schema])
    rows.unionByName(blank).hint("rebalance", column).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


class BucketedTable:
    """A Parquet table of keyed rows in hash buckets; a write touches the buckets of the changed keys only.

    ``rows`` holds the buckets, ``schema`` an empty file with the columns and the number of buckets, which stays
    as it was made, and ``batches`` the ids of applied stream batches, so that a replayed one is a no-op. Choose
    buckets of some hundred megabytes. One writer at a time is assumed; executors may be lost at any time. Should the driver
    end while Spark exchanges files, run the write again: merges and deletes of the same rows give the same table.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = BUCKETS):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self._wanted = buckets
        self._schema: T.StructType | None = None

    # ------------------------------------------------------------------ reading

    def schema(self) -> T.StructType | None:
        """The stored columns, the bucket last; nothing before the first write."""
        if self._schema is None:
            try:
                self._schema = self.spark.read.parquet(f"{self.path}/schema").schema
            except AnalysisException as error:
                if not _missing(error):
                    raise
        return self._schema

    @property
    def buckets(self) -> int:
        schema = self.schema()
        return self._wanted if schema is None else schema[BUCKET].metadata["buckets"]

    def exists(self) -> bool:
        return self.schema() is not None

    def scan(self) -> DataFrame:
        """All rows with their bucket, a partition column."""
        schema = self.schema()
        if schema is None:
            raise FileNotFoundError(f"no table under {self.path}")
        try:
            stored = self.spark.read.schema(schema).parquet(f"{self.path}/rows")
        except AnalysisException as error:
            if not _missing(error):
                raise
            return self.spark.createDataFrame([], schema)
        return stored.where(F.col(self.keys[0]).isNotNull())

    def read(self) -> DataFrame:
        return self.scan().drop(BUCKET)

    def slice(self, index: int, count: int) -> DataFrame:
        """Slice ``index/count`` (1-based): whole buckets, so the scan opens only those.

        More slices than buckets cut each bucket further by the hash of the key.
        """
        if not 1 <= index <= count:
            raise ValueError(f"slice {index}/{count} does not exist")
        own, n = self.buckets, index - 1
        rows = self.scan()
        if count <= own:
            return rows.where(F.col(BUCKET).isin([b for b in range(own) if b % count == n])).drop(BUCKET)
        inner = count // own + (n % own < count % own)
        part = F.pmod(F.xxhash64(F.lit("slice"), *self.keys), F.lit(inner)) == F.lit(n // own)
        return rows.where((F.col(BUCKET) == n % own) & part).drop(BUCKET)

    def lookup(self, wanted: DataFrame) -> DataFrame:
        """Rows of the listed keys; only their buckets are opened."""
        some = self._placed(wanted.select(*self.keys).distinct())
        return self._in(self.touched(some)).drop(BUCKET).join(some.drop(BUCKET), self.keys, "left_semi")

    # ------------------------------------------------------------------ writing

    def _placed(self, rows: DataFrame, template: T.StructType | None = None) -> DataFrame:
        """Rows plus their bucket. Keys are hashed in the type in which they are stored."""
        schema = self.schema() or template or rows.schema
        stored: list[Column] = [F.col(k).cast(schema[k].dataType) for k in self.keys]
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*stored), F.lit(self.buckets)).cast("int"))

    def touched(self, placed: DataFrame) -> list[int]:
        """The buckets that occur, at most :attr:`buckets` numbers."""
        return sorted(r[0] for r in placed.select(BUCKET).distinct().collect())

    def _in(self, buckets: Sequence[int]) -> DataFrame:
        return self.scan().where(F.col(BUCKET).isin(list(buckets)))

    def _make(self, rows: DataFrame) -> None:
        """Store the columns of a new table."""
        number = F.lit(0).cast("int").alias(BUCKET, metadata={"buckets": self._wanted})
        rows.limit(0).select(*[c for c in rows.columns if c != BUCKET], number).write.mode("overwrite").parquet(f"{self.path}/schema")
        self._schema = None

    def has_batch(self, batch_id: int) -> bool:
        try:
            done = self.spark.read.schema("batch_id long").parquet(f"{self.path}/batches")
        except AnalysisException as error:
            if not _missing(error):
                raise
            return False
        return not done.where(F.col("batch_id") == batch_id).isEmpty()

    def _done(self, batch_id: int | None) -> None:
        if batch_id is not None:
            self.spark.range(1).select(F.lit(batch_id).cast("long").alias("batch_id")).write.mode("append").parquet(f"{self.path}/batches")

    def rewrite(self, changed: DataFrame, change: Callable[[DataFrame], DataFrame], like: DataFrame | None = None,
                batch_id: int | None = None) -> list[int]:
        """Rewrite the buckets of the keys in ``changed``; returns their numbers.

        ``change`` gets all rows of these buckets and returns what they shall hold; it may add, alter and drop
        rows of changed keys. A table that does not exist is made with the columns of ``like``. A batch that
        was applied before changes nothing.
        """
        if batch_id is not None and self.has_batch(batch_id):
            return []
        if not self.exists():
            self._make((like if like is not None else changed).drop(BUCKET))
        touched = self.touched(self._placed(changed.select(*self.keys)))
        if touched:
            before = self._in(touched).drop(BUCKET)
            after = self._placed(change(before).select(*before.columns))
            overwrite_partitions(after, f"{self.path}/rows", BUCKET, touched)
        self._done(batch_id)
        return touched

    def commit(self, rows: DataFrame, batch_id: int | None = None) -> None:
        """Replace the whole content. The rows may be read from this table."""
        if batch_id is not None and self.has_batch(batch_id):
            return
        if not self.exists():
            self._make(rows)
        columns = [c for c in self.schema().names if c != BUCKET]
        missing = [c for c in rows.columns if c not in columns]
        if missing:
            raise ValueError(f"columns that the table does not have: {missing}")
        overwrite_partitions(self._placed(rows.select(*columns)), f"{self.path}/rows", BUCKET, range(self.buckets))
        self._done(batch_id)
