"""Declarative filters compiled to Spark predicates.

``compile_filter`` turns a filter dictionary into one Column built from plain
expressions, so it reaches the scan. ``apply_filter`` adds the keys that need
another table (subtrees, root assets, external ids) as semi joins.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.geo import geo_relation

Filter = Mapping[str, Any]

# Filter keys by the kind of test they ask for.
EXACT_KEYS = {
    "name", "source", "type", "subtype", "unit", "unitExternalId", "isString", "isStep", "mimeType",
    "uploaded", "writeProtected", "externalId", "isPublic", "destinationType", "conflictMode",
    "hasBlockedError", "projectName", "published", "format", "status", "dataSetId", "rootId",
    "dbName", "tableName",
}
RANGE_KEYS = {
    "createdTime", "lastUpdatedTime", "startTime", "endTime", "uploadedTime",
    "sourceCreatedTime", "sourceModifiedTime", "confidence",
}
PREFIX_KEYS = {"externalIdPrefix": "external_id", "directoryPrefix": "directory"}
REGEX_KEYS = {"nameRegex": "name", "queryRegex": "query"}
MEMBER_KEYS = {
    "parentIds": "parent_id",
    "parentExternalIds": "parent_external_id",
    "statuses": "status",
    "sourceTypes": "source_type",
    "targetTypes": "target_type",
    "sourceExternalIds": "source_external_id",
    "targetExternalIds": "target_external_id",
    "nodeIds": "node_id",
    "treeIndexes": "tree_index",
}
JOIN_KEYS = {"assetSubtreeIds", "rootAssetIds"}


def column_name(key: str) -> str:
    """``lastUpdatedTime`` -> ``last_updated_time``."""
    return re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", key).lower()


# ------------------------------------------------------------------ predicates

def range_test(column: Column, bounds: Mapping[str, Any]) -> Column:
    """Inclusive range; a null never matches."""
    unknown = set(bounds) - {"min", "max", "isNull"}
    if unknown:
        raise ValueError(f"unknown range bound {sorted(unknown)}")
    if "isNull" in bounds:
        if len(bounds) > 1:
            raise ValueError("isNull does not combine with min or max")
        return column.isNull() if bounds["isNull"] else column.isNotNull()
    test = column.isNotNull()
    if bounds.get("min") is not None:
        test = test & (column >= F.lit(bounds["min"]))
    if bounds.get("max") is not None:
        test = test & (column <= F.lit(bounds["max"]))
    return test


def active_at(start: Column, end: Column, bounds: Mapping[str, Any]) -> Column:
    """Active at some point of the inclusive range; no start is never active, no end is open."""
    unknown = set(bounds) - {"min", "max"}
    if unknown:
        raise ValueError(f"unknown range bound {sorted(unknown)}")
    test = start.isNotNull()
    if bounds.get("max") is not None:
        test = test & (start <= F.lit(bounds["max"]))
    if bounds.get("min") is not None:
        test = test & (end.isNull() | (end >= F.lit(bounds["min"])))
    return test


def metadata_test(column: Column, pairs: Mapping[str, str]) -> Column:
    test = F.lit(True)
    for key, value in pairs.items():
        test = test & F.coalesce(F.try_element_at(column, F.lit(key)) == F.lit(value), F.lit(False))
    return test


def labels_test(column: Column, spec: Mapping[str, Sequence]) -> Column:
    names = lambda items: [i["externalId"] if isinstance(i, Mapping) else i for i in items]
    tests = []
    for mode, items in spec.items():
        wanted = F.array(*[F.lit(n) for n in names(items)])
        if mode == "containsAny":
            tests.append(F.coalesce(F.arrays_overlap(column, wanted), F.lit(False)))
        elif mode == "containsAll":
            tests.append(column.isNotNull() & (F.size(F.array_except(wanted, column)) == 0))
        else:
            raise ValueError(f"unknown label test {mode!r}")
    return _all(tests)


def properties_test(column: Column, spec: Mapping[str, Mapping[str, Sequence[str]]]) -> Column:
    """Values of one property OR-ed; properties and categories AND-ed."""
    tests = []
    for category, properties in spec.items():
        for name, values in properties.items():
            found = F.try_element_at(F.try_element_at(column, F.lit(category)), F.lit(name))
            tests.append(F.coalesce(found.isin([str(v) for v in values]), F.lit(False)))
    return _all(tests)


def box_test(box: Column, query: Mapping[str, Sequence[float]]) -> Column:
    """Overlap of ``struct<min array, max array>`` with a query box on three axes."""
    if len(query.get("min", ())) != 3 or len(query.get("max", ())) != 3:
        raise ValueError("a bounding box needs exactly three min and three max values")
    tests = []
    for axis in range(3):
        tests.append(F.get(box["min"], F.lit(axis)) <= F.lit(float(query["max"][axis])))
        tests.append(F.get(box["max"], F.lit(axis)) >= F.lit(float(query["min"][axis])))
    return _all(tests)


def _all(tests: Sequence[Column]) -> Column:
    result = F.lit(True)
    for test in tests:
        result = result & test
    return result


# -------------------------------------------------------------------- compiler

def compile_filter(spec: Filter, columns: Mapping[str, str] | None = None) -> Column:
    """One predicate of all keys AND-ed. ``columns`` renames default columns."""
    renamed = columns or {}
    col = lambda name: F.col(renamed.get(name, name))
    tests = []
    for key, value in spec.items():
        if key == "metadata":
            test = metadata_test(col("metadata"), value)
        elif key == "activeAtTime":
            test = active_at(col("start_time"), col("end_time"), value)
        elif key in RANGE_KEYS:
            test = range_test(col(column_name(key)), value)
        elif key in PREFIX_KEYS:
            test = col(PREFIX_KEYS[key]).startswith(F.lit(value))
        elif key in REGEX_KEYS:
            test = col(REGEX_KEYS[key]).rlike(value)
        elif key == "labels":
            test = labels_test(col("labels"), value)
        elif key in ("assetIds", "assetExternalIds"):
            name = column_name(key)
            wanted = F.array(*[F.lit(v) for v in value])
            test = F.coalesce(F.arrays_overlap(col(name), wanted), F.lit(False))
        elif key in ("assetId", "securityCategoryId"):
            test = col(column_name(key)).isin(list(value) if isinstance(value, (list, tuple)) else [value])
        elif key in MEMBER_KEYS:
            test = col(MEMBER_KEYS[key]).isin(list(value))
        elif key == "root":
            has_parent = F.trim(F.coalesce(col("parent_external_id"), F.lit(""))) != ""
            test = ~has_parent if value else has_parent
        elif key == "dataSetIds":
            test = _data_set_test(col, value)
        elif key == "geoLocation":
            test = geo_relation(col("geo_location"), value["relation"], value["shape"])
        elif key == "properties":
            test = properties_test(col("properties"), value)
        elif key in ("boundingBox", "intersectsBoundingBox"):
            test = box_test(col("bounding_box"), value)
        elif key == "severity":
            test = col("severity") >= F.lit(int(value))
        elif key == "message":
            text = value["substring"] if isinstance(value, Mapping) else value
            test = col("message").contains(F.lit(text))
        elif key in EXACT_KEYS:
            test = col(column_name(key)) == F.lit(value)
        else:
            raise ValueError(f"unknown filter key {key!r}")
        tests.append(test)
    return _all(tests)


def _data_set_test(col, items: Sequence) -> Column:
    ids = [i["id"] for i in items if isinstance(i, Mapping) and "id" in i]
    ids += [i for i in items if not isinstance(i, Mapping)]
    if any(isinstance(i, Mapping) and "externalId" in i for i in items):
        raise ValueError("data set external ids are resolved by apply_filter")
    return col("data_set_id").isin(ids)


def mapping_filter(spec: Filter, mode: str = "filter") -> Column:
    """3D asset-mapping filters.

    ``filter`` takes exactly one of assetIds, nodeIds, treeIndexes. ``list`` takes
    nodeId, else assetId, else a box; the first one present decides.
    """
    if mode == "filter":
        kinds = {"assetIds": "asset_id", "nodeIds": "node_id", "treeIndexes": "tree_index"}
        given = [k for k in kinds if spec.get(k) is not None]
        if len(given) != 1 or set(spec) - set(kinds):
            raise ValueError("give exactly one of assetIds, nodeIds, treeIndexes")
        return F.col(kinds[given[0]]).isin(list(spec[given[0]]))
    if spec.get("nodeId") is not None:
        return F.col("node_id") == F.lit(spec["nodeId"])
    if spec.get("assetId") is not None:
        return F.col("asset_id") == F.lit(spec["assetId"])
    if spec.get("intersectsBoundingBox") is not None:
        return box_test(F.col("bounding_box"), spec["intersectsBoundingBox"])
    return F.lit(True)


def raw_modified_window(column: Column, after: int | None = None, until: int | None = None) -> Column:
    """Raw-row change window: lower bound exclusive, upper bound inclusive."""
    test = column.isNotNull()
    if after is not None:
        test = test & (column > F.lit(after))
    if until is not None:
        test = test & (column <= F.lit(until))
    return test


def half_open(column: Column, start: int | None = None, end: int | None = None) -> Column:
    """``[start, end)`` window of points or row numbers; start defaults to 0."""
    test = column >= F.lit(0 if start is None else start)
    return test if end is None else test & (column < F.lit(end))


# ------------------------------------------------------------------ join-based

def linked_to(df: DataFrame, asset_keys: DataFrame, link: str = "asset_ids", asset_key: str | None = None) -> DataFrame:
    """Rows linked to any of ``asset_keys``.

    A scalar link is one semi join. For link arrays each distinct array is exploded once and joined, and
    the rows come back by a semi join on the array itself: the link alone decides, so rows without
    a key and rows that repeat one are judged each for itself.
    """
    asset_key = asset_key or asset_keys.columns[0]
    wanted = asset_keys.select(F.col(asset_key).alias("_asset")).distinct()
    if df.schema[link].dataType.typeName() != "array":
        return df.join(wanted, df[link] == wanted["_asset"], "left_semi")
    arrays = df.select(F.col(link).alias("_links")).distinct()
    linked = arrays.select("_links", F.explode("_links").alias("_asset")).join(wanted, "_asset", "left_semi").select("_links")
    return df.join(linked, df[link] == linked["_links"], "left_semi")


def apply_filter(df: DataFrame, spec: Filter, lookups: Mapping[str, DataFrame] | None = None,
                 columns: Mapping[str, str] | None = None, link: str = "asset_ids") -> DataFrame:
    """Filter ``df``; keys that need another table read ``assets`` or ``data_sets`` from ``lookups``."""
    from millrace.operators.hierarchy import ascend, subtree

    lookups = lookups or {}
    plain = {k: v for k, v in spec.items() if k not in JOIN_KEYS}
    data_sets = plain.get("dataSetIds", [])
    named = [i["externalId"] for i in data_sets if isinstance(i, Mapping) and "externalId" in i]
    if named:
        del plain["dataSetIds"]
    if "assetExternalIds" in plain and "asset_external_ids" not in df.columns:
        names = plain.pop("assetExternalIds")
        assets = lookups["assets"]
        df = linked_to(df, assets.where(F.col("external_id").isin(list(names))).select("id"), link)
    df = df.where(compile_filter(plain, columns))
    if named:
        sets = lookups["data_sets"]
        by_id = [i["id"] if isinstance(i, Mapping) else i for i in data_sets if not isinstance(i, Mapping) or "id" in i]
        # Bare ids count as they are, known to ``data_sets`` or not.
        bare = df.sparkSession.createDataFrame([(i,) for i in by_id], "_set long")
        wanted = sets.where(F.col("external_id").isin(named)).select(F.col("id").cast("long").alias("_set")).union(bare)
        df = df.join(wanted, df["data_set_id"] == wanted["_set"], "left_semi")
    if "assetSubtreeIds" in spec:
        assets = lookups["assets"]
        members = subtree(assets, asset_ids(assets, spec["assetSubtreeIds"]))
        df = linked_to(df, members, link, _asset_key(df, link))
    if "rootAssetIds" in spec:
        assets = lookups["assets"]
        roots = asset_ids(assets, spec["rootAssetIds"]).withColumnRenamed("external_id", "top")
        below = ascend(assets).reached.join(roots, "top", "left_semi").select(F.col("id").alias("external_id"))
        df = linked_to(df, assets.join(below, "external_id", "left_semi"), link, _asset_key(df, link))
    return df


def asset_ids(assets: DataFrame, items: Sequence) -> DataFrame:
    """``(external_id)`` of the listed assets: ``{"externalId": text}``, ``{"id": number}``, text or number."""
    named = [i["externalId"] if isinstance(i, Mapping) else i for i in items
             if isinstance(i, str) or isinstance(i, Mapping) and "externalId" in i]
    numbers = [i["id"] if isinstance(i, Mapping) else i for i in items
               if isinstance(i, int) or isinstance(i, Mapping) and "externalId" not in i]
    test = F.col("external_id").isin(named)
    return assets.where(test | F.col("id").isin(numbers) if numbers else test).select("external_id").distinct()


def _asset_key(df: DataFrame, link: str) -> str:
    """The asset column that a link holds: the internal id where it is a number."""
    kind = df.schema[link].dataType
    kind = getattr(kind, "elementType", kind)
    return "id" if kind.typeName() in ("long", "integer") else "external_id"
