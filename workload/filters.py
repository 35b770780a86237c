"""Scans, filters, retrieves and counts."""

from pyspark.sql import functions as F

from millrace.functions.geo import geo_relation, point, polygon

from millrace.lineage import scratch_path
from millrace.operators.merge import in_request_order, retrieve
from millrace.plans.filters import apply_filter, compile_filter
from millrace.sources.tables import scan_slice
from millrace.workspace import Workspace
from workload.mapping import ASSETS, EVENTS, RAW, assets, events, raw_json, table
from workload.registry import query

T0, T1 = 852_076_800_000, 915_148_800_000   # 1997-01-01, 1999-01-01 UTC


@query("list_filtered_events", f"""WITH {EVENTS}
SELECT external_id, type, subtype, source, price FROM ev
WHERE type = 'O' AND source = 'src1' AND start_time >= {T0} AND start_time <= {T1}""")
def list_filtered_events(spark, sf):
    spec = {"type": "O", "source": "src1", "startTime": {"min": T0, "max": T1}}
    return events(spark, sf).where(compile_filter(spec)).select("external_id", "type", "subtype", "source", "price")


@query("filter_active_at_time", f"""WITH {EVENTS}
SELECT external_id, start_time, end_time FROM ev
WHERE start_time IS NOT NULL AND start_time <= {T1} AND (end_time IS NULL OR end_time >= {T0})""")
def filter_active_at_time(spark, sf):
    return events(spark, sf).where(compile_filter({"activeAtTime": {"min": T0, "max": T1}})) \
        .select("external_id", "start_time", "end_time")


@query("filter_range_null", f"""WITH {EVENTS}
SELECT external_id, start_time FROM ev WHERE end_time IS NULL AND start_time >= {T0}""")
def filter_range_null(spark, sf):
    spec = {"endTime": {"isNull": True}, "startTime": {"min": T0}}
    return events(spark, sf).where(compile_filter(spec)).select("external_id", "start_time")


@query("filter_prefix", f"WITH {EVENTS} SELECT external_id FROM ev WHERE starts_with(external_id, '12')")
def filter_prefix(spark, sf):
    return events(spark, sf).where(compile_filter({"externalIdPrefix": "12"})).select("external_id")


@query("filter_labels_any", f"WITH {EVENTS} SELECT external_id FROM ev WHERE list_has_any(labels, ['L1', 'M3'])")
def filter_labels_any(spark, sf):
    return events(spark, sf).where(compile_filter({"labels": {"containsAny": ["L1", "M3"]}})).select("external_id")


@query("filter_labels_all", f"WITH {EVENTS} SELECT external_id FROM ev WHERE list_has_all(labels, ['L1', 'M3'])")
def filter_labels_all(spark, sf):
    spec = {"labels": {"containsAll": [{"externalId": "L1"}, {"externalId": "M3"}]}}
    return events(spark, sf).where(compile_filter(spec)).select("external_id")


@query("filter_metadata", f"WITH {EVENTS} SELECT external_id FROM ev WHERE band = '3' AND subtype = '1-URGENT'")
def filter_metadata(spark, sf):
    spec = {"metadata": {"band": "3", "priority": "1-URGENT"}}
    return events(spark, sf).where(compile_filter(spec)).select("external_id")


@query("filter_asset_ids", f"WITH {EVENTS} SELECT external_id, asset_id FROM ev WHERE asset_id IN (7, 42, 99)")
def filter_asset_ids(spark, sf):
    return events(spark, sf).where(compile_filter({"assetIds": [7, 42, 99]})).select(
        "external_id", F.get("asset_ids", F.lit(0)).alias("asset_id"))


@query("filter_data_sets", f"WITH {EVENTS} SELECT external_id FROM ev WHERE data_set_id IN (2, 4)")
def filter_data_sets(spark, sf):
    # Data sets are taken from the regions: id = region key, external id = region name.
    sets = table(spark, sf, "region").select(
        F.col("r_regionkey").cast("long").alias("id"), F.concat(F.lit("ds"), F.col("r_regionkey").cast("string")).alias("external_id"))
    spec = {"dataSetIds": [{"id": 2}, {"externalId": "ds4"}]}
    return apply_filter(events(spark, sf), spec, {"data_sets": sets}).select("external_id")


@query("filter_root", f"WITH {ASSETS} SELECT external_id FROM assets WHERE parent_external_id IS NOT NULL AND parent_external_id IN ('R1', 'ROOT')")
def filter_root(spark, sf):
    return assets(spark, sf).where(compile_filter({"root": False, "parentExternalIds": ["R1", "ROOT"]})).select("external_id")


@query("filter_name_regex", f"WITH {ASSETS} SELECT external_id FROM assets WHERE regexp_matches(name, '[02468]7$')")
def filter_name_regex(spark, sf):
    return assets(spark, sf).where(compile_filter({"nameRegex": "[02468]7$"})).select("external_id")


@query("subtree_filter", f"""WITH RECURSIVE {ASSETS},
sub AS (SELECT external_id, id FROM assets WHERE external_id IN ('R1', 'N7')
        UNION SELECT a.external_id, a.id FROM assets a JOIN sub s ON a.parent_external_id = s.external_id),
{EVENTS}
SELECT external_id FROM ev WHERE asset_id + 10000 IN (SELECT id FROM sub)""")
def subtree_filter(spark, sf):
    linked = events(spark, sf).withColumn(
        "asset_ids", F.transform("asset_ids", lambda a: F.concat(F.lit("C"), a.cast("string"))))
    spec = {"assetSubtreeIds": [{"externalId": "R1"}, {"externalId": "N7"}]}
    return apply_filter(linked, spec, {"assets": assets(spark, sf)}).select("external_id")


@query("root_asset_filter", f"""WITH {EVENTS}
SELECT e.external_id FROM ev e JOIN customer c ON e.asset_id = c.c_custkey WHERE e.type = 'F'""")
def root_asset_filter(spark, sf):
    linked = events(spark, sf).withColumn(
        "asset_ids", F.transform("asset_ids", lambda a: F.concat(F.lit("C"), a.cast("string"))))
    spec = {"rootAssetIds": [{"externalId": "ROOT"}], "type": "F"}
    return apply_filter(linked, spec, {"assets": assets(spark, sf)}).select("external_id")


@query("retrieve_by_ids", f"""WITH {EVENTS}, {ASSETS}
SELECT e.external_id, e.id, e.price FROM ev e
WHERE e.external_id IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer)
   OR e.id IN (SELECT p_partkey * 2 FROM part)""")
def retrieve_by_ids(spark, sf):
    by_external = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("external_id"), F.lit(None).cast("long").alias("id"))
    by_id = table(spark, sf, "part").select(
        F.lit(None).cast("string").alias("external_id"), (F.col("p_partkey") * 2).alias("id"))
    items = by_external.unionByName(by_id)
    return retrieve(events(spark, sf), items).select("external_id", "id", "price")


@query("retrieve_in_order", f"""WITH {EVENTS}
SELECT external_id, description FROM ev WHERE external_id IN ('77', '5', '1024')""")
def retrieve_in_order(spark, sf):
    return in_request_order(events(spark, sf), ["77", "5", "1024", "5", "none"]).select("external_id", "description")


@query("scan_slices_complete", f"WITH {EVENTS} SELECT external_id, price FROM ev")
def scan_slices_complete(spark, sf):
    source = events(spark, sf)
    parts = [scan_slice(source, "external_id", i, 4) for i in range(1, 5)]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.select("external_id", "price")


@query("aggregate_count", f"""WITH {EVENTS}
SELECT count(*) AS "count" FROM ev WHERE type = 'O' AND start_time >= {T0}""")
def aggregate_count(spark, sf):
    return events(spark, sf).where(compile_filter({"type": "O", "startTime": {"min": T0}})).agg(F.count(F.lit(1)).alias("count"))


@query("aggregate_values", """SELECT o_orderpriority AS value, count(*) AS "count" FROM orders GROUP BY 1""")
def aggregate_values(spark, sf):
    return events(spark, sf).groupBy(F.col("subtype").alias("value")).agg(F.count(F.lit(1)).alias("count"))


@query("limit_first_keys", """SELECT o_orderkey AS id, o_totalprice AS price FROM orders ORDER BY o_orderkey LIMIT 25""")
def limit_first_keys(spark, sf):
    return events(spark, sf).orderBy("id").limit(25).select("id", "price")


@query("raw_projection", f"WITH {RAW} SELECT key, last_updated_time, trim(name) AS name, k FROM raw")
def raw_projection(spark, sf):
    from millrace.functions.values import value_to_long, value_to_string
    from millrace.sources.raw import parse_raw_rows, raw_scan

    rows, _ = parse_raw_rows(raw_json(spark, sf), "plant", "log")
    found = raw_scan(rows, "plant", "log", columns=["name", "k"])
    return found.select("key", "last_updated_time", value_to_string(F.col("name")).alias("name"),
                        value_to_long(F.col("k")).alias("k"))


W0, W1 = 1_704_153_600_000, 1_704_758_400_000   # 2024-01-02, 2024-01-09 UTC


@query("raw_modified_window", f"""WITH {RAW} SELECT key, last_updated_time FROM raw
WHERE last_updated_time > {W0} AND last_updated_time <= {W1}""")
def raw_modified(spark, sf):
    from millrace.sources.raw import parse_raw_rows, raw_scan

    rows, _ = parse_raw_rows(raw_json(spark, sf), "plant", "log")
    return raw_scan(rows, "plant", "log", columns=[], after=W0, until=W1).select("key", "last_updated_time")


def _places(spark, sf):
    """Suppliers and customers as points and squares on a lon/lat grid."""
    k = F.col("c_custkey")
    lon, lat = (k % 340 - 170).cast("double"), ((k * 7) % 160 - 80).cast("double")
    square = F.array(F.array(
        F.array(lon, lat), F.array(lon + 4, lat), F.array(lon + 4, lat + 2), F.array(lon, lat + 2), F.array(lon, lat)))
    shape = F.when(k % 2 == 0, point(lon, lat)).otherwise(polygon(square))
    return table(spark, sf, "customer").select(k.alias("id"), shape.alias("geo_location"))


_PLACES = """places AS (
  SELECT c_custkey AS id, c_custkey % 340 - 170 AS x0, (c_custkey * 7) % 160 - 80 AS y0,
         c_custkey % 340 - 170 + CASE WHEN c_custkey % 2 = 0 THEN 0 ELSE 4 END AS x1,
         (c_custkey * 7) % 160 - 80 + CASE WHEN c_custkey % 2 = 0 THEN 0 ELSE 2 END AS y1 FROM customer)"""
_RECTANGLE = {"type": "Polygon", "coordinates": [[[-60, -30], [90, -30], [90, 45], [-60, 45], [-60, -30]]]}
_TRIANGLE = {"type": "Polygon", "coordinates": [[[-100, -50], [100, -50], [0, 70], [-100, -50]]]}


@query("geo_filter", f"WITH {_PLACES} SELECT id FROM places WHERE x0 <= 90 AND x1 >= -60 AND y0 <= 45 AND y1 >= -30")
def geo_filter(spark, sf):
    spec = {"geoLocation": {"relation": "INTERSECTS", "shape": _RECTANGLE}}
    return _places(spark, sf).where(compile_filter(spec)).select("id")


@query("geo_disjoint", f"WITH {_PLACES} SELECT id FROM places WHERE NOT (x0 <= 90 AND x1 >= -60 AND y0 <= 45 AND y1 >= -30)")
def geo_disjoint(spark, sf):
    return _places(spark, sf).where(geo_relation(F.col("geo_location"), "DISJOINT", _RECTANGLE)).select("id")


_IN = "({y} >= -50 AND 120 * ({x} + 100) - 100 * ({y} + 50) >= 0 AND 120 * (100 - {x}) - 100 * ({y} + 50) >= 0)"


@query("geo_within_triangle", f"WITH {_PLACES} SELECT id FROM places WHERE " + " AND ".join(
    _IN.format(x=x, y=y) for x in ("x0", "x1") for y in ("y0", "y1")))
def geo_within_triangle(spark, sf):
    return _places(spark, sf).where(geo_relation(F.col("geo_location"), "WITHIN", _TRIANGLE)).select("id")


@query("files_join_content", """
SELECT d.doc_id AS id, octet_length(encode(d.text)) AS content_length, l.doc_id IS NOT NULL AS has_metadata,
       CAST(l.quality AS BIGINT) AS quality
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def files_join_content(spark, sf):
    from millrace.sources.files import join_contents

    contents = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("external_id"), F.col("doc_id").alias("id"),
        F.octet_length("text").cast("long").alias("content_length"))
    files = table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("external_id"), F.col("doc_id").alias("id"), F.col("quality").cast("long").alias("quality"))
    return join_contents(contents, files).select("id", "content_length", "has_metadata", "quality")


@query("files_directory_mime", """
SELECT doc_id AS id FROM documents WHERE starts_with('/' || source || '/', '/src1') AND lang = 'en'""")
def files_directory_mime(spark, sf):
    files = table(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit("/"), "source", F.lit("/")).alias("directory"), F.col("lang").alias("mime_type"))
    return files.where(compile_filter({"directoryPrefix": "/src1", "mimeType": "en"})).select(F.col("doc_id").alias("id"))


@query("filter_data_sets_mixed", f"WITH {EVENTS} SELECT external_id FROM ev WHERE data_set_id IN (1, 2, 4)")
def filter_data_sets_mixed(spark, sf):
    sets = table(spark, sf, "region").select(
        F.col("r_regionkey").cast("long").alias("id"), F.concat(F.lit("ds"), F.col("r_regionkey").cast("string")).alias("external_id"))
    spec = {"dataSetIds": [1, {"id": 2}, {"externalId": "ds4"}]}
    return apply_filter(events(spark, sf), spec, {"data_sets": sets}).select("external_id")


@query("filter_data_sets_unknown_id", f"WITH {EVENTS} SELECT external_id FROM ev WHERE data_set_id IN (1, 4)")
def filter_data_sets_unknown_id(spark, sf):
    """A bare id that the table of data sets does not hold selects its rows all the same."""
    sets = table(spark, sf, "region").where("r_regionkey <> 1").select(
        F.col("r_regionkey").cast("long").alias("id"), F.concat(F.lit("ds"), F.col("r_regionkey").cast("string")).alias("external_id"))
    spec = {"dataSetIds": [1, {"externalId": "ds4"}, {"externalId": "none"}]}
    return apply_filter(events(spark, sf), spec, {"data_sets": sets}).select("external_id")


@query("subtree_filter_null_keys", f"""WITH RECURSIVE {ASSETS},
sub AS (SELECT external_id, id FROM assets WHERE external_id IN ('R1', 'N7')
        UNION SELECT a.external_id, a.id FROM assets a JOIN sub s ON a.parent_external_id = s.external_id),
{EVENTS}
SELECT id, CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'same' ELSE external_id END AS external_id
FROM ev WHERE asset_id + 10000 IN (SELECT id FROM sub)""")
def subtree_filter_null_keys(spark, sf):
    """Rows without a key, and rows that repeat one, are judged by their own links."""
    key = F.when(F.col("id") % 3 == 1, F.lit("same")).when(F.col("id") % 3 == 2, F.col("external_id"))
    rows = _by_number(spark, sf).withColumn("external_id", key)
    spec = {"assetSubtreeIds": [{"externalId": "R1"}, "N7"]}
    return apply_filter(rows, spec, {"assets": assets(spark, sf)}).select("id", "external_id")


def _by_number(spark, sf):
    """Events linked by the internal ids of their customers."""
    return events(spark, sf).withColumn("asset_ids", F.transform("asset_ids", lambda a: (a + 10000).cast("long")))


@query("subtree_filter_by_id", f"""WITH RECURSIVE {ASSETS},
sub AS (SELECT external_id, id FROM assets WHERE external_id IN ('R1', 'N7') OR id = 10005
        UNION SELECT a.external_id, a.id FROM assets a JOIN sub s ON a.parent_external_id = s.external_id),
{EVENTS}
SELECT external_id FROM ev WHERE asset_id + 10000 IN (SELECT id FROM sub)""")
def subtree_filter_by_id(spark, sf):
    known = {r["external_id"]: r["id"] for r in assets(spark, sf).where(F.col("external_id").isin("R1", "N7")).collect()}
    spec = {"assetSubtreeIds": [{"id": known["R1"]}, known["N7"], 10005]}
    return apply_filter(_by_number(spark, sf), spec, {"assets": assets(spark, sf)}).select("external_id")


@query("root_filter_by_id", f"""WITH {EVENTS}
SELECT e.external_id FROM ev e JOIN customer c ON e.asset_id = c.c_custkey WHERE e.type = 'P'""")
def root_filter_by_id(spark, sf):
    root = assets(spark, sf).where("external_id = 'ROOT'").first()["id"]
    spec = {"rootAssetIds": [root], "type": "P"}
    return apply_filter(_by_number(spark, sf), spec, {"assets": assets(spark, sf)}).select("external_id")


def _stored(spark, sf):
    """A workspace that holds the events."""
    ws = Workspace(spark, scratch_path(spark, "workspace"))
    ws.events.table.commit(events(spark, sf))
    return ws


@query("workspace_aggregate_count", f"""WITH {EVENTS}
SELECT count(*) AS "count" FROM ev WHERE type = 'O' AND start_time >= {T0}""")
def workspace_aggregate_count(spark, sf):
    return _stored(spark, sf).events.aggregate({"type": "O", "startTime": {"min": T0}})


@query("workspace_aggregate_values", """SELECT o_orderpriority AS value, count(*) AS "count" FROM orders GROUP BY 1""")
def workspace_aggregate_values(spark, sf):
    return _stored(spark, sf).events.aggregate(field="subtype")


@query("workspace_list_first", f"""WITH {EVENTS}
SELECT external_id, price, row_number() OVER (ORDER BY external_id) AS position FROM ev ORDER BY external_id LIMIT 25""")
def workspace_list_first(spark, sf):
    rows = _stored(spark, sf).events.list(limit=25)
    # The order of the result itself is what counts: positions follow the rows as they come.
    place = [(r["external_id"], i) for i, r in enumerate(rows.select("external_id").collect(), 1)]
    positions = spark.createDataFrame(place, "external_id string, position long")
    return rows.select("external_id", "price").join(positions, "external_id")


@query("retrieve_positions", f"""WITH {EVENTS}
SELECT external_id, description, CASE external_id WHEN '77' THEN 1 WHEN '5' THEN 2 ELSE 3 END::BIGINT AS position
FROM ev WHERE external_id IN ('77', '5', '1024')""")
def retrieve_positions(spark, sf):
    rows = in_request_order(events(spark, sf), ["77", "5", "1024", "5", "none"]).select("external_id", "description").collect()
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows, 1)], "external_id string, description string, position long")
