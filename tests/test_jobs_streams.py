import pytest
from pyspark.sql import functions as F

from millrace.operators.merge import MergeSpec
from millrace.operators.runs import latest_metrics, run_gaps, with_job_details, with_latest_status
from millrace.plans.transform import TransformationRunner, apply_rows, destination_spec
from millrace.sources.tables import VersionedTable
from millrace.streaming.publisher import ChangeReader, file_stream, run_stream
from millrace.streaming.sink import MergeSink, buffered_upload, stream_aggregates
from millrace.streaming.state import StateStore, assign, expand, forget, invalid_entries, outside_state
from millrace.workspace import Workspace

EV = "external_id string, type string, description string"


# -------------------------------------------------------------- transformations

@pytest.fixture
def setup(spark, frame, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "events"))
    table.commit(frame(EV, ("a", "t", "d"), ("b", "t", None)))
    frame(EV, ("b", None, "B"), ("c", "n", None)).createOrReplaceTempView("staged")
    return table, TransformationRunner(spark, str(tmp_path / "log"))


@pytest.mark.parametrize("mode,ignore,expected,metrics", [
    ("upsert", True, [("a", "t", "d"), ("b", "t", "B"), ("c", "n", None)], {"read": 2, "created": 1, "updated": 1, "deleted": 0}),
    ("upsert", False, [("a", "t", "d"), ("b", None, "B"), ("c", "n", None)], {"read": 2, "created": 1, "updated": 1, "deleted": 0}),
    ("update", True, [("a", "t", "d"), ("b", "t", "B")], {"read": 2, "created": 0, "updated": 1, "deleted": 0}),
    ("delete", True, [("a", "t", "d")], {"read": 2, "created": 0, "updated": 0, "deleted": 1}),
])
def test_conflict_modes(setup, rows, mode, ignore, expected, metrics):
    table, runner = setup
    query = "SELECT external_id FROM staged" if mode == "delete" else "SELECT * FROM staged"
    result = runner.run("job", query, table, "events", mode, ignore)
    assert result.status == "Completed" and result.metrics == metrics
    assert rows(table.read()) == expected
    assert rows(runner.metrics(result.job_id), "name", "count") == sorted(metrics.items())


def test_abort(setup, rows):
    table, runner = setup
    failed = runner.run("job", "SELECT * FROM staged", table, "events", "abort")
    assert failed.status == "Failed" and "already exists" in failed.error
    assert rows(table.read(), "external_id") == [("a",), ("b",)]
    done = runner.run("job", "SELECT * FROM staged WHERE external_id = 'c'", table, "events", "abort")
    assert done.metrics == {"read": 1, "created": 1, "updated": 0, "deleted": 0}
    assert rows(runner.jobs(), "status") == [("Completed",), ("Failed",)]


def test_destinations(frame):
    for kind in ("assets", "datapoints", "sequence_rows", "raw", "labels", "string_datapoints"):
        assert destination_spec(kind).keys
    for kind in ("instances", "nothing"):
        with pytest.raises(ValueError):
            destination_spec(kind)
    with pytest.raises(ValueError):
        apply_rows(frame(EV, ("a", "t", "d")), frame(EV + ", extra int", ("a", "t", "d", 1)), "events", "upsert")
    with pytest.raises(ValueError):
        apply_rows(frame(EV, ("a", "t", "d")), frame(EV, ("a", "t", "d")), "events", "merge")


def test_hierarchy_destination(frame, rows):
    ddl = "external_id string, parent_external_id string, name string"
    target = frame(ddl, ("r", None, "root"), ("a", "r", "A"), ("b", "r", "B"))
    source = frame(ddl, ("r", None, "root"), ("a", "r", "AA"), ("n", "a", "N"))
    after = apply_rows(target, source, "asset_hierarchy", "upsert")
    assert rows(after, "external_id", "name", "_change") == [("a", "AA", "updated"), ("n", "N", "created"), ("r", "root", "untouched")]


# -------------------------------------------------------------------------- runs

def test_runs(frame, rows):
    ddl = "external_id string, created_time long, status string, message string"
    df = frame(ddl, ("p", 0, "seen", None), ("p", 50_000, "seen", None), ("p", 200_000, "seen", "late"),
               ("p", 250_000, "failure", "broken"), ("q", 7, "success", None))
    assert rows(run_gaps(df)) == [("p", 50_000, 200_000, 150_000)]
    with pytest.raises(ValueError):
        run_gaps(df, 1_000)
    feeds = frame("external_id string", ("p",), ("q",), ("z",))
    assert rows(with_latest_status(feeds, df)) == [
        ("p", None, 250_000, 200_000, "broken"), ("q", 7, None, None, None), ("z", None, None, None, None)]
    jobs = frame("job_id int, transformation_id int, status string, created_time long",
                 (1, 1, "Completed", 1), (2, 1, "Failed", 2), (3, 1, "Running", 3))
    assert rows(with_job_details(frame("id int", (1,), (2,)), jobs)) == [(1, 3, 2, "Failed"), (2, None, None, None)]
    metrics = frame("job_id int, timestamp long, name string, count long", (1, 1, "read", 5), (1, 2, "read", 9))
    assert rows(latest_metrics(metrics)) == [(1, "read", 2, 9)]


# ----------------------------------------------------------------------- polling

CH = "k string, last_updated_time long, type string"


def test_windows_touch_without_overlap(frame, rows):
    df = frame(CH, ("a", 0, "x"), ("b", 1000, "x"), ("c", 1001, "y"), ("late", 5000, "x"))
    reader = ChangeReader(lambda: df, offset_ms=500)
    first = rows(reader.poll(1500), "k")
    reader.advance(1500)
    assert first == [("a",), ("b",)] and reader.bound == 1000
    assert rows(reader.poll(1400), "k") == []          # the clock went back
    assert rows(reader.poll(5500), "k") == [("c",), ("late",)]


def test_start_end_filter_and_consumer(frame, rows):
    df = frame(CH, ("a", 0, "x"), ("b", 1000, "x"), ("c", 2000, "y"), ("d", 3000, "x"))
    reader = ChangeReader(lambda: df, filter={"type": "x"}, start_ms=1000, end_ms=3000, offset_ms=500)
    seen, clock = [], iter([600, 1500, 2600, 9000])
    reader.run(lambda batch: seen.append(rows(batch, "k")), clock=lambda: next(clock), sleep=lambda s: None)
    assert seen == [[("b",)], [("d",)]]
    for bad in ({"offset_ms": 1}, {"interval_ms": 1}, {"start_ms": 5, "end_ms": 1}):
        with pytest.raises(ValueError):
            ChangeReader(lambda: df, **bad)


def test_abort_and_failed_consumer(frame):
    df = frame(CH, ("a", 1000, "x"))
    reader = ChangeReader(lambda: df, offset_ms=500)
    with pytest.raises(RuntimeError):
        reader.run(lambda batch: (_ for _ in ()).throw(RuntimeError("no")), clock=lambda: 5000, sleep=lambda s: None)
    assert reader.bound == -1                           # the batch comes again
    reader.run(lambda batch: reader.abort(), clock=lambda: 5000, sleep=lambda s: None)
    assert reader.finished()


def test_restart_goes_on(spark, frame, rows, tmp_path):
    df = frame(CH, ("a", 1000, "x"), ("b", 2000, "x"))
    bounds = VersionedTable(spark, str(tmp_path / "bounds"))
    ChangeReader(lambda: df, offset_ms=500, bounds=bounds).advance(1500)
    assert rows(ChangeReader(lambda: df, offset_ms=500, bounds=bounds).poll(9000), "k") == [("b",)]


# --------------------------------------------------------------------- streaming

def test_file_stream_filter_and_batches(spark, frame, rows, tmp_path):
    source = str(tmp_path / "in")
    for batch in ([("a", 1, "x"), ("b", 2, "y")], [("c", 3, "x")]):
        frame(CH, *batch).coalesce(1).write.mode("append").parquet(source)
    schema = spark.read.parquet(source).schema
    seen = []
    stream = file_stream(spark, source, schema, {"type": "x"}, start_ms=1, end_ms=3, max_files=1)
    run_stream(stream, lambda df, n: seen.extend(rows(df, "k")), str(tmp_path / "ck")).awaitTermination()
    assert sorted(seen) == [("a",), ("c",)]
    frame(CH, ("d", 3, "x")).coalesce(1).write.mode("append").parquet(source)
    run_stream(stream, lambda df, n: seen.extend(rows(df, "k")), str(tmp_path / "ck")).awaitTermination()
    assert sorted(seen) == [("a",), ("c",), ("d",)]      # only the new file


def test_buffered_upload_is_idempotent(spark, frame, rows, tmp_path):
    source = str(tmp_path / "in")
    frame("external_id string, type string, ord int", ("a", "1", 1), ("a", "2", 2), ("b", "1", 1)).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema("external_id string, type string, ord int").parquet(source)
    sink = MergeSink(VersionedTable(spark, str(tmp_path / "t")), MergeSpec(), order_by=("ord",))
    done = []
    buffered_upload(stream, sink, str(tmp_path / "ck"), None, on_upload=lambda df, n: done.append(n)).awaitTermination()
    assert rows(sink.table.read()) == [("a", "2"), ("b", "1")] and done == [0]
    sink.write(frame("external_id string, type string, ord int", ("z", "9", 1)), 0)      # replay
    assert rows(sink.table.read()) == [("a", "2"), ("b", "1")]
    errors = []
    class Broken:
        def write(self, df, n):
            raise RuntimeError("down")
    with pytest.raises(Exception):
        buffered_upload(stream, Broken(), str(tmp_path / "ck2"), None, on_error=errors.append).awaitTermination()
    assert str(errors[0]) == "down"
    with pytest.raises(ValueError):
        buffered_upload(stream, sink, str(tmp_path / "ck3"), 5)


def test_stream_windows_close_with_the_watermark(spark, frame, rows, tmp_path):
    source = str(tmp_path / "in")
    ddl = "series_id string, ms long, value_num double"
    add = lambda *data: frame(ddl, *data).select(
        "series_id", F.timestamp_millis("ms").alias("ts"), "value_num").coalesce(1).write.mode("append").parquet(source)
    add(("a", 0, 1.0), ("a", 1000, 3.0))
    add(("a", 120_000, 5.0))
    add(("a", 130_000, 5.0))
    add(("a", 2000, 100.0))                               # too late: the first minute is closed
    stream = spark.readStream.schema("series_id string, ts timestamp, value_num double").option(
        "maxFilesPerTrigger", 1).parquet(source)
    out = str(tmp_path / "out")
    stream_aggregates(stream, "1m", "10 seconds").writeStream.format("parquet").outputMode("append").option(
        "checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(out).awaitTermination()
    assert rows(spark.read.parquet(out)) == [("a", 0, 2, 4.0, 1.0, 3.0)]


# -------------------------------------------------------------------------- state

def test_watermark_state(spark, frame, rows, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    values = "key string, value long"
    state = expand(store.load(), frame(values, ("a", 5), ("a", 9), ("b", 2)))
    store.commit(state)
    assert store.get("a") == (5, 9) and store.get("zz") is None
    store.commit(expand(store.load(), frame(values, ("a", 7), ("a", 12))))
    assert store.get("a") == (5, 12)                      # monotone
    assert rows(outside_state(frame(values, ("a", 4), ("a", 5), ("a", 12), ("a", 13), ("new", 0)), store.load())) == [
        ("a", 4), ("a", 13), ("new", 0)]
    only_high = assign(store.load(), frame("key string, low long, high long", ("h", None, 10)))
    assert rows(outside_state(frame(values, ("h", -99), ("h", 11)), only_high)) == [("h", 11)]
    store.commit(forget(only_high, frame("key string", ("a",))))
    assert rows(store.keys()) == [("b",), ("h",)]
    bad = assign(store.load(), frame("key string, low long, high long", ("n", None, None)))
    assert rows(invalid_entries(bad), "key") == [("n",)]
    big = assign(store.load(), frame("key string, low long, high long", ("big", 2**62 + 1, None)))
    store.commit(big)
    assert store.get("big")[0] == 2**62 + 1


# ---------------------------------------------------------------------- workspace

def test_workspace_verbs(spark, frame, rows, tmp_path):
    ws = Workspace(spark, str(tmp_path / "ws"))
    ddl = "id long, external_id string, type string, asset_ids array<string>, data_set_id long, last_updated_time long"
    ws.events.upsert(frame(ddl, (1, "a", "x", ["p"], 7, 1), (2, "b", "y", ["q"], 8, 2)))
    ws.assets.upsert(frame("external_id string, parent_external_id string, name string", ("root", None, "R"), ("p", "root", "P"), ("q", None, "Q")))
    ws.data_sets.create(frame("id long, external_id string", (7, "seven")))
    assert rows(ws.events.list({"type": "x"}), "external_id") == [("a",)]
    assert rows(ws.events.list({"assetSubtreeIds": ["root"]}), "external_id") == [("a",)]
    assert rows(ws.events.list({"dataSetIds": [{"externalId": "seven"}]}), "external_id") == [("a",)]
    assert ws.events.list(limit=1).count() == 1
    assert ws.events.list(slice="1/2").count() + ws.events.list(slice="2/2").count() == 2
    assert rows(ws.events.retrieve(["b", "none"], [1]), "external_id") == [("a",), ("b",)]
    assert rows(ws.events.aggregate(field="type")) == [("x", 1), ("y", 1)]
    assert ws.events.aggregate({"type": "y"}).first()[0] == 1
    assert rows(ws.events.stream(start_ms=2).poll(10**6), "external_id") == [("b",)]
    ws.events.delete(["a", "none"])
    assert rows(ws.events.list(), "external_id") == [("b",)]
    with pytest.raises(Exception):
        ws.data_sets.create(frame("id long, external_id string", (9, "seven")))
    plan = ws.assets.synchronize(frame("external_id string, parent_external_id string, name string", ("root", None, "R2")))
    assert rows(plan, "external_id", "change") == [("p", "deleted"), ("root", "changed")]
    assert rows(ws.assets.list(), "external_id", "name") == [("q", "Q"), ("root", "R2")]
    ws.assets.delete(["root"], recursive=True)
    assert rows(ws.assets.list(), "external_id") == [("q",)]
    with pytest.raises(AttributeError):
        ws.nothing


def test_synchronised_deletes_are_counted(spark, frame, tmp_path):
    ddl = "external_id string, parent_external_id string, name string"
    table = VersionedTable(spark, str(tmp_path / "assets"))
    table.commit(frame(ddl, ("r", None, "root"), ("a", "r", "A"), ("b", "r", "B")))
    runner = TransformationRunner(spark, str(tmp_path / "log"))
    done = runner.run("sync", frame(ddl, ("r", None, "root"), ("a", "r", "AA"), ("n", "a", "N")), table, "asset_hierarchy")
    assert done.status == "Completed" and done.metrics == {"read": 3, "created": 1, "updated": 1, "deleted": 1}
    assert {r["external_id"] for r in table.read().collect()} == {"r", "a", "n"}
