"""Relationships, 3D nodes and boxes."""

from pyspark.sql import Window, functions as F

from millrace.lineage import materialize
from millrace.operators.graph import api_text, valid_edges, with_resources
from millrace.operators.spatial import (
    ancestor_nodes, box_join, create_mappings, delete_mappings, mappings_with_nodes, node_list, subtree_nodes,
)
from millrace.plans.filters import compile_filter, mapping_filter
from workload.mapping import NODES, RELATIONSHIPS, nodes_3d, relationships, table
from workload.registry import query


@query("relationship_resources", f"""WITH {RELATIONSHIPS}
SELECT r.external_id, o.o_orderstatus AS source_status, p.p_name AS part_name, s.s_name AS supplier_name, count(*) AS n
FROM rel r LEFT JOIN orders o ON CAST(o.o_orderkey AS VARCHAR) = r.source_external_id
LEFT JOIN part p ON r.target_type = 'asset' AND CAST(p.p_partkey AS VARCHAR) = r.target_external_id
LEFT JOIN supplier s ON r.target_type = 'file' AND CAST(s.s_suppkey AS VARCHAR) = r.target_external_id
GROUP BY ALL""")
def relationship_resources(spark, sf):
    keyed = lambda name, key, *cols: table(spark, sf, name).select(F.col(key).cast("string").alias("external_id"), *cols)
    resources = {
        "event": keyed("orders", "o_orderkey", F.col("o_orderstatus").alias("status")),
        "asset": keyed("part", "p_partkey", F.col("p_name").alias("name")),
        "file": keyed("supplier", "s_suppkey", F.col("s_name").alias("supplier")),
    }
    found = with_resources(relationships(spark, sf), resources)
    read = lambda end, name: F.try_variant_get(end, f"$.{name}", "string")
    return found.groupBy(
        "external_id", read("source", "status").alias("source_status"),
        read("target", "name").alias("part_name"), read("target", "supplier").alias("supplier_name"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query("relationship_valid", f"""WITH {RELATIONSHIPS}
SELECT external_id, start_time, confidence FROM rel
WHERE start_time <= 915148800000 AND (end_time IS NULL OR end_time >= 852076800000) AND confidence >= 0.95""")
def relationship_valid(spark, sf):
    edges = valid_edges(relationships(spark, sf), 852_076_800_000, 915_148_800_000, 0.95)
    return edges.select("external_id", "start_time", "confidence")


@query("relationship_filter", f"""WITH {RELATIONSHIPS}
SELECT external_id FROM rel WHERE target_type = 'file' AND target_external_id IN ('3', '17') AND confidence <= 0.97 AND confidence >= 0.93""")
def relationship_filter(spark, sf):
    spec = {"targetTypes": ["file"], "targetExternalIds": ["3", "17"], "confidence": {"min": 0.93, "max": 0.97}}
    return relationships(spark, sf).where(compile_filter(spec)).select("external_id")


# ------------------------------------------------------------------- 3D nodes

_WALK = f"""WITH RECURSIVE {NODES},
down AS (SELECT node_id AS root_node_id, node_id, 0 AS d FROM nodes WHERE node_id IN (101, 1007, 10005)
         UNION ALL SELECT w.root_node_id, n.node_id, w.d + 1 FROM nodes n JOIN down w ON n.parent_id = w.node_id)
"""


def _ids(spark, *ids):
    return spark.createDataFrame([(1, 1, i) for i in ids], "model_id bigint, revision_id bigint, node_id bigint")


@query("tree_subtree", _WALK + "SELECT root_node_id, node_id FROM down")
def tree_subtree(spark, sf):
    return subtree_nodes(nodes_3d(spark, sf), _ids(spark, 101, 1007, 10005)).select("root_node_id", "node_id")


@query("tree_subtree_depth", _WALK + "SELECT root_node_id, node_id FROM down WHERE d <= 1")
def tree_subtree_depth(spark, sf):
    return subtree_nodes(nodes_3d(spark, sf), _ids(spark, 101, 1007, 10005), depth=1).select("root_node_id", "node_id")


@query("tree_ancestors", f"""WITH RECURSIVE {NODES},
up AS (SELECT node_id AS of_node_id, node_id, parent_id FROM nodes
       UNION ALL SELECT u.of_node_id, n.node_id, n.parent_id FROM nodes n JOIN up u ON n.node_id = u.parent_id)
SELECT of_node_id, node_id FROM up""")
def tree_ancestors(spark, sf):
    nodes = nodes_3d(spark, sf)
    return ancestor_nodes(nodes, nodes).select("of_node_id", "node_id")


@query("node_property_filter", f"""WITH {NODES}
SELECT node_id, name FROM nodes WHERE kind IN ('Building', 'Machinery') AND required = 'false' AND pdms = 'PNOD'""")
def node_property_filter(spark, sf):
    spec = {"properties": {"Item": {"Type": ["Building", "Machinery"], "Required": ["false"]}, "PDMS": {"Type": ["PNOD"]}}}
    return nodes_3d(spark, sf).where(compile_filter(spec)).select("node_id", "name")


@query("node_list_first", f"WITH {NODES} SELECT node_id, depth FROM nodes WHERE depth < 3")
def node_list_first(spark, sf):
    return node_list(nodes_3d(spark, sf).where("depth < 3")).select("node_id", "depth")


@query("box_intersect", f"""WITH {NODES}
SELECT node_id FROM nodes WHERE x0 <= 60 AND x1 >= 20 AND y0 <= 55.5 AND y1 >= 30 AND z0 <= 15 AND z1 >= 5""")
def box_intersect(spark, sf):
    box = {"min": [20, 30, 5], "max": [60, 55.5, 15]}
    return nodes_3d(spark, sf).where(compile_filter({"boundingBox": box})).select("node_id")


@query("box_join", f"""WITH {NODES}, probe AS (
  SELECT s_suppkey, round(s_acctbal / 100) AS x0, s_suppkey % 100 AS y0, s_nationkey AS z0,
         round(s_acctbal / 100) + s_suppkey % 20 AS x1, s_suppkey % 100 + s_suppkey % 15 AS y1, s_nationkey + s_suppkey % 9 AS z1 FROM supplier)
SELECT n.node_id, p.s_suppkey AS probe_id FROM nodes n JOIN probe p
  ON n.x0 <= p.x1 AND n.x1 >= p.x0 AND n.y0 <= p.y1 AND n.y1 >= p.y0 AND n.z0 <= p.z1 AND n.z1 >= p.z0""")
def boxes(spark, sf):
    k = F.col("s_suppkey")
    lo = [F.round(F.col("s_acctbal") / 100), (k % 100).cast("double"), F.col("s_nationkey").cast("double")]
    hi = [lo[0] + k % 20, lo[1] + k % 15, lo[2] + k % 9]
    probes = table(spark, sf, "supplier").select(
        k.alias("probe_id"), F.struct(F.array(*lo).alias("min"), F.array(*hi).alias("max")).alias("bounding_box"))
    nodes = nodes_3d(spark, sf).where("bounding_box IS NOT NULL").select("node_id", "bounding_box")
    return box_join(nodes, probes).select(F.col("_a.node_id").alias("node_id"), F.col("_b.probe_id").alias("probe_id"))


def _mappings(spark, sf):
    """Orders as mappings of a node (the customer's) to an asset (the order's)."""
    return table(spark, sf, "orders").select(
        F.lit(1).cast("long").alias("model_id"), F.lit(1).cast("long").alias("revision_id"),
        (F.col("o_custkey") + 10000).alias("node_id"), F.col("o_orderkey").alias("asset_id"))


@query("mappings_in_box", f"""WITH {NODES}
SELECT n.node_id, o.o_orderkey AS asset_id FROM orders o JOIN nodes n ON n.node_id = o.o_custkey + 10000
WHERE x0 <= 60 AND x1 >= 20 AND y0 <= 55.5 AND y1 >= 30 AND z0 <= 15 AND z1 >= 5""")
def mappings_in_box(spark, sf):
    box = {"intersectsBoundingBox": {"min": [20, 30, 5], "max": [60, 55.5, 15]}}
    found = mappings_with_nodes(_mappings(spark, sf), nodes_3d(spark, sf).select(
        "model_id", "revision_id", "node_id", "bounding_box"))
    return found.where(mapping_filter(box, "list")).select("node_id", "asset_id")


@query("mappings_edited", """
SELECT o_custkey + 10000 AS node_id, o_orderkey AS asset_id FROM orders WHERE o_orderkey % 3 <> 0
UNION ALL SELECT o_custkey + 10001, o_orderkey FROM orders WHERE o_orderkey % 10 = 0""")
def mappings_edited(spark, sf):
    current = _mappings(spark, sf)
    moved = current.where("asset_id % 10 = 0").withColumn("node_id", F.col("node_id") + 1)
    left = delete_mappings(current, current.where("asset_id % 3 = 0"))
    return create_mappings(left, moved.unionByName(left)).select("node_id", "asset_id")


@query("api_types", """
SELECT CASE p_size % 5 WHEN 0 THEN 'asset' WHEN 1 THEN 'timeSeries' WHEN 2 THEN 'file' WHEN 3 THEN 'event' ELSE 'sequence' END AS type,
       count(*) AS n FROM part GROUP BY 1""")
def api_types(spark, sf):
    names = F.array(*map(F.lit, ("ASSET", "TIME_SERIES", "FILE", "EVENT", "SEQUENCE")))
    kinds = table(spark, sf, "part").select(api_text(F.element_at(names, (F.col("p_size") % 5 + 1).cast("int"))).alias("type"))
    return kinds.groupBy("type").agg(F.count(F.lit(1)).alias("n"))


@query("node_list_positions", f"""WITH RECURSIVE {NODES},
way AS (SELECT node_id, depth, lpad(node_id::VARCHAR, 9, '0') AS path FROM nodes WHERE parent_id IS NULL
        UNION ALL SELECT n.node_id, n.depth, w.path || lpad(n.node_id::VARCHAR, 9, '0') FROM nodes n JOIN way w ON n.parent_id = w.node_id)
SELECT node_id, depth, row_number() OVER (ORDER BY path) AS position FROM way""")
def node_list_positions(spark, sf):
    """The place of every node in the listing, taken from the rows as the listing gives them."""
    listed = node_list(nodes_3d(spark, sf)).select("node_id", "depth").withColumn("at", F.monotonically_increasing_id())
    kept = materialize(listed, "listing")
    # An id is the partition in the high bits and the row inside it in the low 33. Only the row counts of
    # the partitions are cumulated in one place; node rows do not move there.
    split = kept.withColumn("part", F.shiftright("at", 33)).withColumn("row", F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = split.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    offsets = materialize(sizes.select("part", before.alias("before")), "offsets")
    return split.join(offsets, "part").select("node_id", "depth", (F.col("before") + F.col("row") + 1).alias("position"))
