"""Bucketed tables: what a write touches, emptied buckets, slices, and the workspace on top."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.operators.merge import MergeSpec
from millrace.sources.buckets import BUCKET, BucketedTable
from millrace.sources.order import with_position
from millrace.streaming.sink import MergeSink, buffered_upload
from millrace.workspace import Workspace

ROW = "external_id string, type string, metadata map<string,string>"


def files(path):
    """Data files per bucket."""
    found = {}
    for f in sorted(Path(path).rglob("*.parquet")):
        bucket = [p for p in f.parts if p.startswith(BUCKET)]
        if bucket:
            found.setdefault(int(bucket[0].split("=")[1]), set()).add(f.name)
    return found


@pytest.fixture
def stored(spark, frame, tmp_path):
    ws = Workspace(spark, str(tmp_path / "ws"), buckets=8)
    ws.events.create(frame(ROW, *[(f"e{i}", "t", {"n": str(i)}) for i in range(60)]))
    return ws


def bucket_of(ws, frame, *keys):
    return {r[0] for r in ws.events.table._placed(frame("external_id string", *[(k,) for k in keys])).select(BUCKET).collect()}


def test_writes_touch_the_buckets_of_changed_keys_only(frame, rows, stored):
    before = files(stored.events.table.path)
    assert set(before) == set(range(8))
    stored.events.upsert(frame(ROW, ("e3", None, {"x": "y"}), ("new", "n", None)))
    after, hit = files(stored.events.table.path), bucket_of(stored, frame, "e3", "new")
    assert {b for b in before if before[b] != after[b]} == hit
    got = {r["external_id"]: r for r in stored.events.table.read().collect()}
    assert len(got) == 61 and got["e3"]["metadata"] == {"n": "3", "x": "y"} and got["e3"]["type"] == "t"

    stored.events.delete(["e3", "nowhere"])
    last = files(stored.events.table.path)
    assert {b for b in after if after[b] != last[b]} <= bucket_of(stored, frame, "e3", "nowhere")
    assert stored.events.table.read().count() == 60 and stored.events.list({"type": "n"}).count() == 1


def test_a_bucket_that_loses_all_rows_is_empty(frame, stored):
    bucket = bucket_of(stored, frame, "e3")
    gone = [k for k in (f"e{i}" for i in range(60)) if bucket_of(stored, frame, k) == bucket]
    stored.events.delete(gone)
    left = stored.events.table.scan()
    assert left.count() == 60 - len(gone) and left.where(F.col(BUCKET) == bucket.pop()).count() == 0
    stored.events.upsert(frame(ROW, ("e3", "back", None)))
    assert stored.events.retrieve(["e3"]).first()["type"] == "back"


def test_delete_of_everything_and_replacement(frame, rows, stored):
    stored.events.delete([f"e{i}" for i in range(60)])
    assert stored.events.table.read().count() == 0 and stored.events.list(limit=3).count() == 0
    stored.events.table.commit(frame(ROW, ("z", "t", None)))
    assert rows(stored.events.table.read(), "external_id") == [("z",)]
    with pytest.raises(ValueError):
        stored.events.table.commit(frame(ROW + ", more int", ("z", "t", None, 1)))


def test_create_checks_the_stored_keys(frame, stored):
    with pytest.raises(Exception, match="already exists"):
        stored.events.create(frame(ROW, ("e1", "t", None)))
    assert stored.events.table.read().count() == 60


@pytest.mark.parametrize("count", [1, 3, 8, 21])
def test_slices_are_whole_buckets(stored, count):
    parts = [{r["external_id"] for r in stored.events.list(slice=f"{i}/{count}").collect()} for i in range(1, count + 1)]
    assert sum(map(len, parts)) == 60 and set().union(*parts) == {f"e{i}" for i in range(60)}
    plan = stored.events.list(slice=f"1/{count}")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bucket" in plan.replace("isnotnull(_bucket#", "_bucket#") or count == 1
    with pytest.raises(ValueError):
        stored.events.list(slice=f"{count + 1}/{count}")


def test_lookup_opens_only_buckets_of_its_keys(frame, stored):
    found = stored.events.retrieve(["e5", "e5", "none"])
    assert [r["external_id"] for r in found.collect()] == ["e5"]
    assert "_bucket" in found._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]


def test_keys_of_another_type_fall_in_the_same_bucket(frame, spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), ["id"], buckets=5)
    table.commit(frame("id long, v string", *[(i, "a") for i in range(20)]))
    change = frame("id int, v string", (7, "b"))
    table.rewrite(change, lambda before: before.join(change.select("id"), "id", "left_anti").unionByName(change))
    assert {(r["id"], r["v"]) for r in table.read().collect()} == {(i, "b" if i == 7 else "a") for i in range(20)}
    assert BucketedTable(spark, str(tmp_path / "t"), ["id"], buckets=99).buckets == 5


def test_flush_touches_its_buckets_and_replays_nothing(spark, frame, rows, tmp_path, stored):
    ddl = "external_id string, type string"
    inbox, table = str(tmp_path / "in"), stored.events.table
    frame(ddl, ("e1", "a"), ("e1", "b"), ("e2", "c")).coalesce(1).write.parquet(inbox)
    before = files(table.path)
    stream = with_position(spark.readStream.schema(ddl).parquet(inbox), newest_file_last=True)
    sink = MergeSink(table, MergeSpec())
    buffered_upload(stream, sink, str(tmp_path / "cp"), interval_ms=None).awaitTermination()
    after = files(table.path)
    assert {b for b in before if before[b] != after[b]} == bucket_of(stored, frame, "e1", "e2")
    assert {r["external_id"]: r["type"] for r in stored.events.retrieve(["e1", "e2"]).collect()} == {"e1": "b", "e2": "c"}
    sink.write(frame(ddl, ("e1", "late")), 0)
    assert files(table.path) == after and table.has_batch(0) and not table.has_batch(1)


def test_assets_rewrite_what_the_plan_changes(spark, frame, rows, tmp_path):
    ws = Workspace(spark, str(tmp_path / "ws"), buckets=8)
    ddl = "external_id string, parent_external_id string, name string"
    tree = [("root", None, "R")] + [(f"n{i}", "root" if i < 3 else f"n{i % 3}", "N") for i in range(40)]
    ws.assets.synchronize(frame(ddl, *tree))
    before = files(ws.assets.table.path)
    ws.assets.synchronize(frame(ddl, *[r for r in tree if r[0] != "n39"], ))
    after = files(ws.assets.table.path)
    assert sum(before[b] != after[b] for b in before) == 1 and ws.assets.table.read().count() == 40
    ws.assets.delete(["n1"], recursive=True)
    assert ws.assets.table.read().where("external_id = 'n1' or parent_external_id = 'n1'").count() == 0
    with pytest.raises(ValueError):
        ws.assets.delete(["n0"])
