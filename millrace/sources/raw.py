"""Schemaless staging rows: typed ingest, projection, windows, upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.merge import SPECS, delete_keys, merge
from millrace.plans.filters import raw_modified_window

# Variant types of a whole number.
_WHOLE = ("TINYINT", "SMALLINT", "INT", "BIGINT")
RAW_KEYS = ("db_name", "table_name", "key")


def parse_raw_rows(lines: DataFrame, db: str, table: str, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """JSON lines to raw rows and rejects.

    A row is an object with textual ``key``, integral ``lastUpdatedTime`` and object
    ``columns``; everything else is a reject with its text and the reason.
    """
    part = lambda v, path: F.try_variant_get(v, path, "variant")
    is_object = lambda v, path: F.coalesce(F.schema_of_variant(part(v, path)).startswith("OBJECT"), F.lit(False))

    def read(v: Column) -> Column:
        reason = (
            F.when(v.isNull(), "not JSON")
            .when(~is_object(v, "$"), "not an object")
            .when(F.coalesce(F.schema_of_variant(part(v, "$.key")) != "STRING", F.lit(True)), "key is not text")
            .when(~F.coalesce(F.schema_of_variant(part(v, "$.lastUpdatedTime")).isin(*_WHOLE), F.lit(False)),
                  "lastUpdatedTime is not a whole number")
            .when(~is_object(v, "$.columns"), "columns is not an object")
        )
        return F.struct(
            reason.alias("reason"), F.try_variant_get(v, "$.key", "string").alias("key"),
            F.try_variant_get(v, "$.lastUpdatedTime", "bigint").alias("last_updated_time"),
            part(v, "$.columns").alias("columns"),
        )

    # The generator keeps filters above it, so every line is parsed once.
    once = F.explode(F.transform(F.array(F.try_parse_json(F.col(column))), read))
    parsed = lines.select(F.col(column).alias("text"), once.alias("r"))
    rows = parsed.where(F.col("r.reason").isNull()).select(
        F.lit(db).alias("db_name"), F.lit(table).alias("table_name"), "r.key", "r.last_updated_time", "r.columns"
    )
    return rows, parsed.where(F.col("r.reason").isNotNull()).select("text", "r.reason")


def raw_scan(rows: DataFrame, db: str, table: str, columns: Sequence[str] | None = None,
             after: int | None = None, until: int | None = None) -> DataFrame:
    """Rows of one table, with projection and change window.

    ``columns=None`` keeps the whole payload; an empty list keeps the row keys only.
    """
    found = rows.where((F.col("db_name") == db) & (F.col("table_name") == table))
    if after is not None or until is not None:
        found = found.where(raw_modified_window(F.col("last_updated_time"), after, until))
    if columns is None:
        return found
    return found.select(*project_columns(columns))


def project_columns(columns: Sequence[str]) -> list[Column]:
    picked = [F.try_variant_get("columns", f"$['{c}']", "variant").alias(c) for c in columns]
    return [F.col("db_name"), F.col("table_name"), F.col("key"), F.col("last_updated_time"), *picked]


def relabel(rows: DataFrame, db: str | None = None, table: str | None = None) -> DataFrame:
    if db is not None:
        rows = rows.withColumn("db_name", F.lit(db))
    if table is not None:
        rows = rows.withColumn("table_name", F.lit(table))
    return rows


def raw_upsert(target: DataFrame, source: DataFrame, order_by: Sequence[str] = ("last_updated_time",)) -> DataFrame:
    """Whole-row upsert on (db, table, key); the last write of a key wins."""
    return merge(target, source, SPECS["raw_rows"], order_by=order_by)


def raw_delete(target: DataFrame, keys: DataFrame) -> DataFrame:
    return delete_keys(target, keys, RAW_KEYS)[0]


def typed_rows(lines: DataFrame, schema: str, required: Sequence[str], column: str = "value") -> tuple[DataFrame, DataFrame]:
    """JSON records to typed rows and rejects.

    Optional fields of another type become null, as do non-text metadata values. A
    record without a required field is a reject.
    """
    parsed = lines.select(F.col(column).alias("text"), F.from_json(column, schema).alias("_r"))
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col("_r")[name].isNull()
    parsed = parsed.withColumn("_bad", F.coalesce(missing, F.lit(True)))
    rows = parsed.where(~F.col("_bad")).select("_r.*")
    return rows, parsed.where("_bad").select("text")
