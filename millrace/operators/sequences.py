"""Sequences: typed rows, wide views, schema diffs, row upserts and deletes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.operators.merge import SPECS, merge
from millrace.plans.filters import half_open

# The value types of a sequence column.
VALUE_TYPES = ("DOUBLE", "LONG", "STRING")
_SPARK_TYPE = {"DOUBLE": "double", "LONG": "long", "STRING": "string"}


def to_long(bodies: DataFrame) -> DataFrame:
    """``(external_id, columns array<struct<external_id, value_type>>, row_number, values array<variant>)``
    to one row per cell, value i typed by column i.

    LONG truncates, null stays null, a number in a STRING column is an error.
    """
    cell = F.explode(F.arrays_zip(F.col("columns").alias("c"), F.col("values").alias("v")))
    cells = bodies.select("external_id", "row_number", cell.alias("_cell"))
    value, kind = F.col("_cell.v"), F.col("_cell.c.value_type")
    holds = F.schema_of_variant(value)
    number = F.try_variant_get(value, "$", "double")
    wrong = F.raise_error(F.concat(F.lit("number in a STRING column: "), F.col("_cell.c.external_id"))).cast("string")
    whole = F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number)).cast("double")
    return cells.select(
        "external_id", "row_number", F.col("_cell.c.external_id").alias("column_id"),
        kind.alias("value_type"),
        F.when(kind == "DOUBLE", number).when(kind == "LONG", whole).alias("value_num"),
        F.when(kind == "STRING",
               F.when(holds == "STRING", F.try_variant_get(value, "$", "string"))
               .when(F.is_variant_null(value) | value.isNull(), F.lit(None))
               .otherwise(wrong)).alias("value_string"),
    )


def read_rows(rows: DataFrame, start: int | None = None, end: int | None = None,
              columns: Sequence[str] | None = None, sequences: DataFrame | None = None) -> DataFrame:
    """Cells of ``[start, end)`` rows, of some columns and some sequences."""
    found = rows.where(half_open(F.col("row_number"), start, end))
    if columns is not None:
        found = found.where(F.col("column_id").isin(list(columns)))
    if sequences is not None:
        found = found.join(sequences.select("external_id").distinct(), "external_id", "left_semi")
    return found


def to_wide(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row per (sequence, row number), one typed column per ``{column id: value type}``."""
    picked = []
    for name, kind in columns.items():
        value = F.col("value_string") if kind == "STRING" else F.col("value_num").cast(_SPARK_TYPE[kind])
        picked.append(F.max(F.when(F.col("column_id") == name, value)).alias(name))
    return rows.groupBy("external_id", "row_number").agg(*picked)


def infer_columns(rows: DataFrame) -> DataFrame:
    """Header columns implied by cells: text gives STRING, numbers DOUBLE, mixed or all null is an error."""
    texts, numbers = F.count("value_string"), F.count("value_num")
    label = F.concat_ws(".", "external_id", "column_id")
    bad = F.raise_error(F.concat(F.lit("cannot infer one type for "), label)).cast("string")
    return rows.groupBy("external_id", "column_id").agg(texts.alias("_t"), numbers.alias("_n")).select(
        "external_id", "column_id",
        F.when((F.col("_t") > 0) & (F.col("_n") == 0), "STRING")
        .when((F.col("_n") > 0) & (F.col("_t") == 0), "DOUBLE").otherwise(bad).alias("value_type"),
    )


def missing_columns(rows: DataFrame, header: DataFrame) -> DataFrame:
    """Columns used by cells but absent from the header ``(external_id, column_id, value_type)``."""
    known = header.select("external_id", "column_id")
    return infer_columns(rows.join(known, ["external_id", "column_id"], "left_anti"))


def extend_header(rows: DataFrame, header: DataFrame) -> DataFrame:
    return header.select("external_id", "column_id", "value_type").unionByName(missing_columns(rows, header))


def schema_diff(new: DataFrame, old: DataFrame, replace: bool = False, strict: bool = True) -> DataFrame:
    """``(external_id, column_id, action)``: add, modify, remove (replace only), or type_conflict.

    With ``strict`` a changed type raises, listing at most ten columns.
    """
    a = new.select("external_id", "column_id", F.col("value_type").alias("_new"))
    b = old.select("external_id", "column_id", F.col("value_type").alias("_old"))
    both = a.join(b, ["external_id", "column_id"], "full_outer")
    action = (
        F.when(F.col("_old").isNull(), "add").when(F.col("_new").isNull(), "remove")
        .when(F.col("_old") == F.col("_new"), "modify").otherwise("type_conflict")
    )
    result = both.select("external_id", "column_id", action.alias("action"))
    if not replace:
        result = result.where(F.col("action") != "remove")
    if strict:
        sample = result.where(F.col("action") == "type_conflict").limit(10).collect()
        if sample:
            raise ValueError(f"column types changed: {[(r[0], r[1]) for r in sample]}")
    return result


def upsert_rows(target: DataFrame, cells: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """Cell upsert on (sequence, row, column)."""
    return merge(target, cells, SPECS["sequence_rows"], order_by=order_by)


def delete_rows(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Drop whole rows listed as ``(external_id, row_numbers array<long>)``."""
    listed = wanted.select("external_id", F.explode("row_numbers").alias("row_number")).distinct()
    return rows.join(listed, ["external_id", "row_number"], "left_anti")
