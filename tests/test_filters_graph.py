import itertools
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.operators.graph import api_text, valid_edges, with_resources
from millrace.operators.spatial import ancestor_nodes, box_join, create_mappings, delete_mappings, node_list, subtree_nodes
from millrace.plans.filters import apply_filter, compile_filter, half_open, mapping_filter, raw_modified_window


@pytest.fixture
def keep(rows):
    return lambda df, spec: [r[0] for r in rows(df.where(compile_filter(spec)), "id")]


def test_ranges_and_activity(frame, keep):
    df = frame("id int, start_time long, end_time long", (1, None, 5), (2, 10, None), (3, 10, 20), (4, 21, 30), (5, 1, 9))
    assert keep(df, {"startTime": {"min": 10, "max": 10}}) == [2, 3]
    assert keep(df, {"startTime": {}}) == [2, 3, 4, 5]
    assert keep(df, {"endTime": {"isNull": True}}) == [2]
    assert keep(df, {"endTime": {"isNull": False}, "startTime": {"max": 9}}) == [5]
    assert keep(df, {"activeAtTime": {"min": 20, "max": 20}}) == [2, 3]
    assert keep(df, {"activeAtTime": {"min": 9}}) == [2, 3, 4, 5]
    assert keep(df, {"activeAtTime": {"max": 10}}) == [2, 3, 5]
    for bad in ({"startTime": {"from": 1}}, {"endTime": {"isNull": True, "min": 1}}, {"activeAtTime": {"isNull": True}}, {"nope": 1}):
        with pytest.raises(ValueError):
            compile_filter(bad)


def test_half_open_and_raw_bounds(frame, rows):
    df = frame("t long", (0,), (5,), (6,), (9,))
    read = lambda test: [r[0] for r in rows(df.where(test))]
    assert read(half_open(F.col("t"), 5, 9)) == [5, 6] and read(half_open(F.col("t"))) == [0, 5, 6, 9]
    assert read(raw_modified_window(F.col("t"), 5, 9)) == [6, 9]


def test_text_labels_metadata(frame, keep):
    df = frame("id int, external_id string, labels array<string>, metadata map<string,string>, asset_ids array<long>, parent_external_id string",
               (1, "ab-1", ["x", "y"], {"k": "v", "l": "w"}, [1, 2], None), (2, "AB-2", ["y"], {"k": "V"}, [3], "p"), (3, "ab-3", None, None, None, " "))
    assert keep(df, {"externalIdPrefix": "ab"}) == [1, 3]
    assert keep(df, {"labels": {"containsAny": ["x", "q"]}}) == [1]
    assert keep(df, {"labels": {"containsAll": [{"externalId": "y"}]}}) == [1, 2]
    assert keep(df, {"metadata": {"k": "v", "l": "w"}}) == [1]
    assert keep(df, {"assetIds": [2, 3]}) == [1, 2]
    assert keep(df, {"root": True}) == [1, 3] and keep(df, {"root": False}) == [2]
    with pytest.raises(ValueError):
        compile_filter({"labels": {"containsNone": []}})


def test_filters_reach_the_scan(spark, frame, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    frame("id int, type string, start_time long, note string", (1, "a", 5, "x")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).where(
        compile_filter({"type": "a", "startTime": {"min": 1}, "externalIdPrefix": "x"}, {"external_id": "note"})).select("id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(type,a)" in plan and "GreaterThanOrEqual(start_time,1)" in plan and "StringStartsWith(note,x)" in plan


def test_join_filters(frame, rows):
    assets = frame("external_id string, parent_external_id string, id long", ("r", None, 1), ("a", "r", 2), ("b", "a", 3), ("s", None, 4))
    df = frame("external_id string, asset_ids array<string>, data_set_id long", ("e1", ["b", "a"], 7), ("e2", ["s"], 8), ("e3", None, 9))
    read = lambda spec, **lookups: [r[0] for r in rows(apply_filter(df, spec, {"assets": assets, **lookups}), "external_id")]
    assert read({"assetSubtreeIds": [{"externalId": "a"}]}) == ["e1"]
    assert read({"rootAssetIds": ["s", "r"]}) == ["e1", "e2"]
    sets = frame("id long, external_id string", (8, "set8"), (7, "set7"))
    assert read({"dataSetIds": [{"id": 7}, {"externalId": "set8"}]}, data_sets=sets) == ["e1", "e2"]
    numbered = frame("external_id string, asset_ids array<long>", ("e1", [3]), ("e2", [4]))
    assert [r[0] for r in rows(apply_filter(numbered, {"assetExternalIds": ["b"]}, {"assets": assets}), "external_id")] == ["e1"]


def test_3d_property_and_box_filters(frame, keep):
    ddl = "id int, properties map<string,map<string,string>>, bounding_box struct<min:array<double>,max:array<double>>"
    df = frame(ddl, (1, {"Item": {"Type": "Box", "Required": "false"}}, ([0.0] * 3, [1.0] * 3)),
               (2, {"Item": {"Type": "Group"}, "PDMS": {"Type": "PNOD"}}, ([2.0] * 3, [3.0] * 3)), (3, None, None))
    assert keep(df, {"properties": {"Item": {"Type": ["Box"]}}}) == [1]
    assert keep(df, {"properties": {"Item": {"Type": ["Group", "Box"]}, "PDMS": {"Type": ["PNOD"]}}}) == [2]
    assert keep(df, {"properties": {"Item": {"Type": ["Box"], "Required": ["false"]}}}) == [1]
    assert keep(df, {"boundingBox": {"min": [1, 1, 1], "max": [2, 2, 2]}}) == [1, 2]
    with pytest.raises(ValueError):
        compile_filter({"boundingBox": {"min": [1, 1], "max": [2, 2, 2]}})


def test_mapping_filters(frame, rows):
    df = frame("node_id long, asset_id long, tree_index long", (1, 10, 5), (2, 20, 6))
    assert rows(df.where(mapping_filter({"treeIndexes": [6]})), "node_id") == [(2,)]
    assert rows(df.where(mapping_filter({"nodeId": 1, "assetId": 20}, "list")), "node_id") == [(1,)]
    for bad in ({}, {"assetIds": [1], "nodeIds": [2]}, {"nodeId": 1}):
        with pytest.raises(ValueError):
            mapping_filter(bad)


NODE = "model_id long, revision_id long, node_id long, tree_index long, subtree_size long, depth int, parent long"


def random_tree(rng, n):
    children, out = {0: []}, []
    for i in range(1, n):
        p = rng.randrange(i)
        children.setdefault(p, []).append(i)
        children[i] = children.get(i, [])
    counter = itertools.count()

    def walk(node, parent, depth):
        index = next(counter)
        slot = len(out)
        out.append(None)
        size = 1 + sum(walk(c, node, depth + 1) for c in children.get(node, []))
        out[slot] = (1, 1, node, index, size, depth, parent)
        return size

    walk(0, None, 0)
    return out


def test_tree_containment_against_brute_force(frame, rows):
    tree = random_tree(random.Random(5), 400)
    nodes = frame(NODE, *tree)
    wanted = frame("model_id long, revision_id long, node_id long", *[(1, 1, n) for n in (0, 3, 17, 399, 1000)])
    inside = lambda r, n: r[3] <= n[3] < r[3] + r[4]
    by_id = {r[2]: r for r in tree}
    want = sorted((r, n[2]) for r in (0, 3, 17, 399) for n in tree if inside(by_id[r], n))
    assert rows(subtree_nodes(nodes, wanted), "root_node_id", "node_id") == want
    near = sorted((r, n[2]) for r in (0, 3, 17, 399) for n in tree if inside(by_id[r], n) and n[5] - by_id[r][5] <= 1)
    assert rows(subtree_nodes(nodes, wanted, depth=1), "root_node_id", "node_id") == near
    up = sorted((w, n[2]) for w in (0, 3, 17, 399) for n in tree if inside(n, by_id[w]))
    assert rows(ancestor_nodes(nodes, wanted), "of_node_id", "node_id") == up
    assert [r["node_id"] for r in node_list(nodes, by_node_id=True, limit=3).collect()] == [0, 1, 2]


def test_containment_is_an_equi_join(frame):
    nodes = frame(NODE, *random_tree(random.Random(5), 10))
    plan = subtree_nodes(nodes, nodes.select("model_id", "revision_id", "node_id"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_box_join_against_brute_force(frame, rows):
    rng = random.Random(11)
    def boxes(n, sizes):
        out = []
        for i in range(n):
            lo = [float(rng.randint(-40, 40)) for _ in range(3)]
            edge = rng.choice(sizes)
            out.append((i, (lo, [x + rng.randint(0, edge) for x in lo])))
        return [(i, (lo, [float(x) for x in hi])) for i, (lo, hi) in out]
    a, b = boxes(60, [0, 2, 30]), boxes(40, [1, 8, 60])
    ddl = "id int, bounding_box struct<min:array<double>,max:array<double>>"
    pairs = box_join(frame(ddl, *a), frame(ddl, *b)).select(F.col("_a.id").alias("x"), F.col("_b.id").alias("y"))
    meet = lambda p, q: all(p[0][k] <= q[1][k] and p[1][k] >= q[0][k] for k in range(3))
    assert rows(pairs) == sorted((i, j) for i, p in a for j, q in b if meet(p, q))


def test_box_join_deals_crowded_cells_and_takes_endless_boxes(frame, rows, monkeypatch):
    rng = random.Random(12)
    monkeypatch.setattr("millrace.operators.spatial._HOT", 20)
    ends = [float("-inf"), -1e300, -1.0, -1e-17, 0.0, 1.0, 1e17, float("inf")]
    def boxes(n):
        lo = [[rng.choice(ends) if i % 4 == 0 else rng.randint(0, 3) + 0.5 for _ in range(3)] for i in range(n)]
        return [(i, i % 2, (x, [max(v, rng.choice(ends)) if i % 4 == 0 else v + rng.randint(0, 1) for v in x])) for i, x in enumerate(lo)]
    a, b = boxes(50), boxes(70)
    ddl = "id int, g int, bounding_box struct<min:array<double>,max:array<double>>"
    met = box_join(frame(ddl, *a, (90, 0, None), (91, 0, ([0.0], [1.0]))), frame(ddl, *b), on=("g",))
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert "_piece" in plan and "merge" in plan
    meet = lambda p, q: all(p[0][k] <= q[1][k] and p[1][k] >= q[0][k] for k in range(3))
    want = sorted((i, j) for i, g, p in a for j, h, q in b if g == h and meet(p, q))
    assert rows(met.select(F.col("_a.id").alias("x"), F.col("_b.id").alias("y"))) == want


def test_mappings(frame, rows):
    ddl = "model_id long, revision_id long, node_id long, asset_id long"
    have = frame(ddl, (1, 1, 1, 1))
    both = create_mappings(have, frame(ddl, (1, 1, 1, 1), (1, 1, 2, 1), (1, 1, 2, 1)))
    assert rows(both, "node_id") == [(1,), (2,)]
    assert rows(delete_mappings(both, have), "node_id") == [(2,)]


def test_relationships(frame, rows):
    ddl = ("external_id string, source_type string, source_external_id string, target_type string, target_external_id string, "
           "start_time long, end_time long, confidence double")
    edges = frame(ddl, ("e1", "asset", "a", "event", "x", 1, 5, 0.9), ("e2", "asset", "a", "file", "gone", None, None, 0.5),
                  ("e3", "event", "a", "asset", "a", 1, None, None))
    nodes = {"asset": frame("external_id string, name string", ("a", "pump")), "event": frame("external_id string, kind string", ("x", "stop"))}
    got = with_resources(edges, nodes).select(
        "external_id", F.try_variant_get("source", "$.name", "string"), F.try_variant_get("target", "$.kind", "string"), F.col("target").isNull())
    assert rows(got) == [("e1", "pump", "stop", False), ("e2", "pump", None, True), ("e3", None, None, False)]
    assert rows(valid_edges(edges, 5, 9), "external_id") == [("e1",), ("e3",)]
    assert rows(valid_edges(edges, confidence=0.6), "external_id") == [("e1",)]
    df = frame("t string", ("TIME_SERIES",))
    assert df.select(api_text(F.col("t"))).first()[0] == "timeSeries"
    with pytest.raises(PySparkException):
        frame("t string", ("NODE",)).select(api_text(F.col("t"))).collect()
