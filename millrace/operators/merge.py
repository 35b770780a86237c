"""Keyed merges: last-write-wins dedupe, update and replace upserts, deletes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import PySparkValueError
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions.collections import add_items, merge_map
from millrace.sources.order import POSITION

UPDATE, REPLACE = "update", "replace"

# Field rules. What the value becomes where source and target both hold the key.
SET = "set"                    # update: source if given; replace: source, or null / empty
ALWAYS = "always"              # source value even if unset
KEEP = "keep"                  # target value, immutable after creation
KEEP_IF_ABSENT = "keep_if_absent"  # source if given, never cleared
ADD = "add"                    # update: map keys or array items added; replace: source or empty
BLANK_CLEARS = "blank_clears"  # update: blank text clears, absent keeps
ABSENT_CLEARS = "absent_clears"  # absent or blank text clears
FALSE_IF_ABSENT = "false_if_absent"  # replace: false where absent


@dataclass(frozen=True)
class MergeSpec:
    """How one resource merges: its key, and the rules of fields that are not ``SET``."""

    keys: tuple[str, ...] = ("external_id",)
    update: Mapping[str, str] = field(default_factory=dict)
    replace: Mapping[str, str] = field(default_factory=dict)
    required_on_replace: tuple[str, ...] = ()

    def rule(self, column: str, mode: str) -> str:
        return (self.update if mode == UPDATE else self.replace).get(column, SET)


# Per-resource exceptions to the two merge modes.
SPECS: dict[str, MergeSpec] = {
    "assets": MergeSpec(
        update={"metadata": ADD, "labels": ADD},
        replace={"parent_external_id": KEEP_IF_ABSENT, "parent_id": KEEP_IF_ABSENT},
        required_on_replace=("name",),
    ),
    "events": MergeSpec(update={"metadata": ADD}),
    "timeseries": MergeSpec(
        update={"metadata": ADD, "unit": ABSENT_CLEARS, "unit_external_id": BLANK_CLEARS,
                "is_string": KEEP, "is_step": KEEP},
        replace={"is_string": KEEP, "is_step": KEEP, "unit": ABSENT_CLEARS},
    ),
    "files": MergeSpec(
        update={"metadata": ADD, "labels": ADD, "name": KEEP}, replace={"name": KEEP}
    ),
    "sequences": MergeSpec(update={"metadata": ADD}),
    "data_sets": MergeSpec(
        update={"metadata": ALWAYS}, replace={"write_protected": FALSE_IF_ABSENT}
    ),
    "relationships": MergeSpec(update={"labels": ADD}),
    "extraction_feeds": MergeSpec(
        update={"name": ALWAYS, "data_set_id": ALWAYS, "raw_tables": ADD, "contacts": ADD, "metadata": ADD}
    ),
    "labels": MergeSpec(update={"name": ALWAYS, "description": ALWAYS, "data_set_id": ALWAYS}),
    "three_d_models": MergeSpec(update={"name": ALWAYS, "metadata": ADD}, replace={"name": ALWAYS}),
    "raw_rows": MergeSpec(keys=("db_name", "table_name", "key"), update={"columns": ALWAYS}),
    "datapoints": MergeSpec(keys=("external_id", "ts_ms"), update={"value_num": ALWAYS, "value_string": ALWAYS}),
    "sequence_rows": MergeSpec(
        keys=("external_id", "row_number", "column_id"), update={"value_string": ALWAYS, "value_num": ALWAYS}
    ),
}


def _tie_break(df: DataFrame) -> Column:
    """Whole-row hash, so that reruns pick the same row among equal orders."""
    columns = [c for c in df.columns if c != POSITION]
    hashable = all(
        not isinstance(df.schema[c].dataType, (T.MapType, T.StructType, T.ArrayType, T.VariantType)) for c in columns
    )
    return F.xxhash64(*columns) if hashable else F.xxhash64(F.to_json(F.struct(*columns)))


def last_write_wins(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the last by ``order_by``, or else in input order where ``df`` has :data:`POSITION`.

    Without either there is no last row, so a key that comes with different rows is an error; equal
    rows count once. Combines map-side, so a hot key stays cheap.
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    order_by = list(order_by) or [c for c in (POSITION,) if c in df.columns]
    tie = _tie_break(df)
    order = F.struct(*[F.col(c) for c in order_by], tie.alias("_tie"))
    row = F.max_by(F.struct(*others), order)
    if not order_by:
        kind = T.StructType([df.schema[c] for c in others])
        error = F.raise_error(F.lit(f"rows of one {tuple(keys)} differ and have no order")).cast(kind)
        row = F.when(F.min(tie) == F.max(tie), row).otherwise(error)
    picked = df.groupBy(*keys).agg(row.alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in others]).select(*df.columns)


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raise for a row without its full key."""
    first, *rest = keys
    missing = F.col(first).isNull()
    for k in rest:
        missing = missing | F.col(k).isNull()
    kind = df.schema[first].dataType
    guard = F.when(missing, F.raise_error(F.lit(f"row without key {tuple(keys)}")).cast(kind)).otherwise(F.col(first))
    return df.withColumn(first, guard)


def _is_collection(kind: T.DataType) -> bool:
    return isinstance(kind, (T.MapType, T.ArrayType))


def _empty(kind: T.DataType) -> Column:
    return (F.create_map() if isinstance(kind, T.MapType) else F.array()).cast(kind)


def _given(value: Column, kind: T.DataType) -> Column:
    """Whether a field is provided; an empty map or array is not."""
    return value.isNotNull() & (F.size(value) > 0) if _is_collection(kind) else value.isNotNull()


def _merged(old: Column, new: Column, kind: T.DataType, rule: str, mode: str) -> Column:
    given = _given(new, kind)
    blank = F.trim(F.coalesce(new, F.lit(""))) == "" if isinstance(kind, T.StringType) else ~given
    if rule == KEEP:
        return old
    if rule == KEEP_IF_ABSENT:
        return F.when(given, new).otherwise(old)
    if rule == ABSENT_CLEARS:
        return F.when(~blank, new)
    if rule == BLANK_CLEARS:
        return F.when(new.isNull(), old).when(~blank, new)
    if rule == FALSE_IF_ABSENT:
        return F.coalesce(new, F.lit(False))
    if rule == ALWAYS or mode == REPLACE:
        return F.when(given, new).otherwise(_empty(kind)) if _is_collection(kind) else new
    if rule == ADD:
        combine = merge_map if isinstance(kind, T.MapType) else add_items
        return F.when(given, combine(old, new)).otherwise(old)
    return F.when(given, new).otherwise(old)


def merge(target: DataFrame, source: DataFrame, spec: MergeSpec, mode: str = UPDATE,
          order_by: Sequence[str] = (), ignore_nulls: bool = True, only: str | None = None) -> DataFrame:
    """Upsert ``source`` into ``target``: target columns plus ``_change``.

    ``_change`` is created, updated or untouched. The source is deduplicated by key
    first (the last by ``order_by`` or in input order, see :func:`last_write_wins`), so one full outer join settles creates and updates together. With
    ``ignore_nulls=False`` nulls in columns the source does have overwrite too. ``only`` keeps
    just creates (``"create"``) or just updates (``"update"``) of the source.
    """
    if mode not in (UPDATE, REPLACE):
        raise ValueError(f"unknown merge mode {mode!r}")
    keys = list(spec.keys)
    order_by = list(order_by) or [c for c in (POSITION,) if c in source.columns]
    extra = [c for c in order_by if c not in target.columns]
    given = [c for c in target.columns if c in source.columns]
    new = last_write_wins(require_keys(source.select(*given, *extra), keys), keys, order_by).select(*given)
    values = [f for f in target.schema if f.name not in keys]

    old = target.select(*keys, F.struct(*[F.col(f.name) for f in values]).alias("_old"))
    fresh = new.select(*keys, F.struct(*[
        (F.col(f.name).cast(f.dataType) if f.name in given else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in values
    ]).alias("_new"))
    both = old.join(fresh, keys, {"create": "full_outer", "update": "left"}.get(only, "full_outer"))
    in_old, in_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()

    columns = []
    for f in values:
        o, n = F.col("_old")[f.name], F.col("_new")[f.name]
        rule = spec.rule(f.name, mode)
        result = _merged(o, n, f.dataType, rule, mode)
        if mode == UPDATE and not ignore_nulls and rule == SET and f.name in given:
            result = n
        if mode == REPLACE and f.name in spec.required_on_replace:
            error = F.raise_error(F.lit(f"replace needs {f.name}")).cast(f.dataType)
            result = F.when(n.isNull(), error).otherwise(result)
        if only == "create":
            result = o
        columns.append(F.when(in_old & in_new, result).when(in_old, o).otherwise(n).alias(f.name))
    matched = F.lit("untouched") if only == "create" else F.lit("updated")
    change = F.when(in_old & in_new, matched).when(in_old, F.lit("untouched")).otherwise(F.lit("created"))
    return both.select(*keys, *columns, change.alias("_change")).select(*target.columns, "_change")


def create_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert; a key that already exists, comes twice or is missing is an error.

    The clashes are looked for first, with a bounded sample, so that the error does not depend on
    which rows or columns of the result are used.
    """
    keys = list(keys)
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    state = source.select(*keys, missing.alias("_missing")).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.max("_missing").alias("_missing"))
    known = target.select(*keys, F.lit(True).alias("_known"))
    clash = state.join(known, keys, "left").where("_missing or _known or _n > 1").limit(10).collect()
    for row in clash:
        if row["_missing"]:
            raise PySparkValueError(f"row without key {tuple(keys)}")
    if clash:
        raise PySparkValueError(f"key already exists: {[tuple(r[k] for k in keys) for r in clash]}")
    aligned = source.select(*[
        (F.col(c) if c in source.columns else F.lit(None)).cast(target.schema[c].dataType).alias(c)
        for c in target.columns
    ])
    return target.unionByName(aligned)


def split_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of ``source`` to create and rows to update."""
    known = target.select(*keys)
    return source.join(known, list(keys), "left_anti"), source.join(known, list(keys), "left_semi")


def delete_keys(target: DataFrame, wanted: DataFrame, keys: Sequence[str],
                ignore_unknown: bool = True) -> tuple[DataFrame, DataFrame]:
    """Remaining rows, and the keys that were deleted."""
    listed = wanted.select(*keys).distinct()
    remaining = target.join(listed, list(keys), "left_anti")
    deleted = listed.join(target.select(*keys), list(keys), "left_semi")
    if not ignore_unknown:
        unknown = listed.join(target.select(*keys), list(keys), "left_anti")
        sample = unknown.limit(10).collect()
        if sample:
            raise ValueError(f"unknown keys: {[tuple(r) for r in sample]}")
    return remaining, deleted


def retrieve(df: DataFrame, items: DataFrame, id_column: str = "id", external_column: str = "external_id") -> DataFrame:
    """Rows whose external id or id is listed in ``items(external_id, id)``.

    The two kinds of key stay apart: one semi join each, never an OR-join. A row
    listed both ways comes once; an item with neither key is an error.
    """
    kind = items.schema["external_id"].dataType
    neither = F.col("external_id").isNull() & F.col("id").isNull()
    checked = items.select(
        F.when(neither, F.raise_error(F.lit("item without id")).cast(kind)).otherwise(F.col("external_id")).alias("_ext"),
        F.when(F.col("external_id").isNull(), F.col("id")).alias("_id"),
    )
    externals = checked.where(F.col("_ext").isNotNull()).select("_ext").distinct()
    ids = checked.where(F.col("_id").isNotNull()).select("_id").distinct()
    by_external = df.join(externals, df[external_column] == externals["_ext"], "left_semi")
    by_id = df.join(ids, df[id_column] == ids["_id"], "left_semi")
    only_id = by_id.join(externals, by_id[external_column] == externals["_ext"], "left_anti")
    return by_external.unionByName(only_id)


def resolve_ids(items: DataFrame, df: DataFrame, id_column: str = "id", external_column: str = "external_id") -> DataFrame:
    """Fill the external id of items known only by id, so that one key joins everything."""
    ids = df.select(F.col(id_column).alias("_id"), F.col(external_column).alias("_found"))
    known = items.where(F.col(external_column).isNotNull())
    by_id = items.where(F.col(external_column).isNull())
    filled = by_id.join(ids, by_id[id_column] == ids["_id"], "left").withColumn(external_column, F.col("_found"))
    return known.unionByName(filled.select(*items.columns))


def in_request_order(df: DataFrame, requested: Sequence[str], key: str = "external_id") -> DataFrame:
    """Rows of the requested keys, in request order (first mention counts)."""
    order = list(dict.fromkeys(requested))
    positions = df.sparkSession.createDataFrame(list(zip(order, range(len(order)))), f"{key} string, _pos int")
    return df.join(positions, key).orderBy("_pos").drop("_pos")


def write_volume(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row, cell, character and byte totals of a write set."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    total = lambda parts: sum(parts[1:], parts[0])
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        (F.count(F.lit(1)) * len(columns)).alias("cells"),
        F.sum(total([F.char_length(t) for t in texts])).alias("characters"),
        F.sum(total([F.octet_length(t) for t in texts])).alias("bytes"),
    )
