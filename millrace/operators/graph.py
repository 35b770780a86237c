"""Relationships: typed edges between resources."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from millrace.plans.filters import active_at

# Enum name to API text of relationship ends and sequence value types.
RESOURCE_TYPES = {
    "ASSET": "asset", "TIME_SERIES": "timeSeries", "FILE": "file", "EVENT": "event", "SEQUENCE": "sequence",
}


def api_text(column: Column) -> Column:
    """Enum name to API text; an unknown name is an error."""
    pairs = [F.lit(x) for item in RESOURCE_TYPES.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), column)
    return F.coalesce(found, F.raise_error(F.concat(F.lit("unknown resource type "), column)).cast("string"))


def valid_edges(edges: DataFrame, at_min: int | None = None, at_max: int | None = None,
                confidence: float | None = None) -> DataFrame:
    """Edges active in the inclusive time range, at or above a confidence."""
    bounds = {k: v for k, v in (("min", at_min), ("max", at_max)) if v is not None}
    if bounds:
        edges = edges.where(active_at(F.col("start_time"), F.col("end_time"), bounds))
    if confidence is not None:
        edges = edges.where(F.col("confidence") >= F.lit(confidence))
    return edges


def with_resources(edges: DataFrame, resources: Mapping[str, DataFrame]) -> DataFrame:
    """Attach ``source`` and ``target`` objects (variant); an object that is missing stays null.

    ``resources`` maps API type text to a frame with ``external_id``. All types become
    one node table, so each end is a single left equi join on (type, external id). Resources are
    encoded once each, so the edges move for their two joins only.
    """
    nodes = None
    for kind, df in resources.items():
        part = df.where(F.col("external_id").isNotNull()).select(
            F.lit(kind).alias("_type"), F.col("external_id").cast("string").alias("_id"),
            F.to_variant_object(F.struct(*df.columns)).alias("_object"),
        )
        nodes = part if nodes is None else nodes.unionByName(part)
    result = edges
    for end in ("source", "target"):
        side = nodes.select(
            F.col("_type").alias(f"{end}_type"), F.col("_id").alias(f"{end}_external_id"),
            F.col("_object").alias(end),
        )
        result = result.join(side, [f"{end}_type", f"{end}_external_id"], "left")
    return result.select(*edges.columns, "source", "target")
