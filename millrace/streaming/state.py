"""Per-key low/high watermark state as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.sources.tables import VersionedTable

STATE_DDL = "key string, low bigint, high bigint"


def outside_state(rows: DataFrame, state: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """Rows not covered by the state: unseen key, above high or below low.

    A bound that is unset never excludes.
    """
    known = state.select(F.col("key").alias("_k"), "low", "high", F.lit(True).alias("_seen"))
    v = F.col(value)
    above = F.coalesce(v > F.col("high"), F.lit(False))
    below = F.coalesce(v < F.col("low"), F.lit(False))
    joined = rows.join(known, rows[key] == known["_k"], "left")
    return joined.where(F.col("_seen").isNull() | above | below).select(*rows.columns)


def expand(state: DataFrame, rows: DataFrame, key: str = "key", value: str = "value",
           low: bool = True, high: bool = True) -> DataFrame:
    """State widened by the rows; bounds only ever move outwards."""
    seen = rows.groupBy(F.col(key).cast("string").alias("key")).agg(
        (F.min(value) if low else F.lit(None)).cast("long").alias("_low"),
        (F.max(value) if high else F.lit(None)).cast("long").alias("_high"),
    )
    return state.join(seen, "key", "full_outer").select(
        "key", F.least("low", "_low").alias("low"), F.greatest("high", "_high").alias("high")
    )


def assign(state: DataFrame, values: DataFrame) -> DataFrame:
    """State with the given bounds set outright; a null bound is left as it was."""
    new = values.select("key", F.col("low").alias("_low"), F.col("high").alias("_high"))
    return state.join(new, "key", "full_outer").select(
        "key", F.coalesce("_low", "low").alias("low"), F.coalesce("_high", "high").alias("high")
    )


def forget(state: DataFrame, keys: DataFrame) -> DataFrame:
    return state.join(keys.select("key"), "key", "left_anti")


def invalid_entries(state: DataFrame) -> DataFrame:
    """Entries without any bound."""
    return state.where(F.col("low").isNull() & F.col("high").isNull())


class StateStore:
    """The state table with load and commit; commits are whole, atomic versions."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = VersionedTable(spark, path)

    def load(self) -> DataFrame:
        if not self.table.exists():
            return self.spark.createDataFrame([], STATE_DDL)
        return self.table.read()

    def commit(self, state: DataFrame, batch_id: int | None = None) -> int:
        return self.table.commit(state.select("key", "low", "high"), batch_id)

    def get(self, key: str) -> tuple[int | None, int | None] | None:
        row = self.load().where(F.col("key") == key).first()
        return None if row is None else (row["low"], row["high"])

    def keys(self) -> DataFrame:
        return self.load().select("key")
