"""Streams, watermark state and buffered upserts, compared with their batch results."""

from pyspark.sql import functions as F

from millrace.functions.durations import epoch_ms
from millrace.lineage import scratch_path
from millrace.operators.merge import MergeSpec
from millrace.sources.buckets import BucketedTable
from millrace.sources.order import POSITION, with_position
from millrace.sources.tables import VersionedTable
from millrace.streaming.publisher import ChangeReader, file_stream, raw_changes, run_stream
from millrace.streaming.sink import MergeSink, buffered_upload, stream_aggregates
from millrace.streaming.state import StateStore, expand, outside_state
from workload.mapping import ASSETS, EVENTS, RAW, assets, events, raw_json, table
from workload.registry import query


def _changes(df):
    return df.select(
        "event_id", F.col("event_type").alias("type"), F.col("user_id"), "value", epoch_ms(F.col("ts")).alias("last_updated_time"))


def _stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return _changes(file_stream(spark, f"{sf}/event[s].parquet", schema))


def _replayed(spark, rows, label):
    """Run a stream to its end, appending every batch to a table."""
    out = scratch_path(spark, label)
    query = run_stream(
        rows, lambda batch, n: batch.write.mode("append").parquet(out), scratch_path(spark, f"{label}-progress"))
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


_CHANGES = "(SELECT event_id, event_type AS type, user_id, value, epoch_us(ts) // 1000 AS last_updated_time FROM events)"


@query("stream_publisher_replay", f"SELECT * FROM {_CHANGES}")
def stream_publisher_replay(spark, sf):
    return _replayed(spark, _stream(spark, sf), "replay")


@query("stream_filtered", f"""SELECT * FROM {_CHANGES}
WHERE type = 'click' AND last_updated_time >= 1704500000000 AND last_updated_time <= 1706000000000""")
def stream_filtered(spark, sf):
    from millrace.plans.filters import compile_filter

    spec = {"type": "click", "lastUpdatedTime": {"min": 1_704_500_000_000, "max": 1_706_000_000_000}}
    return _replayed(spark, _stream(spark, sf).where(compile_filter(spec)), "filtered")


@query("change_reader_windows", f"""SELECT * FROM {_CHANGES}
WHERE last_updated_time >= 1704500000000 AND last_updated_time <= 1705900000000 - 30000""")
def change_reader_windows(spark, sf):
    """Four polls of a table; together they hold each row of the period once."""
    reader = ChangeReader(lambda: _changes(table(spark, sf, "events")), start_ms=1_704_500_000_000)
    result = None
    for now in (1_704_800_000_000, 1_705_300_000_000, 1_705_300_000_001, 1_705_900_000_000):
        rows = reader.poll(now)
        reader.advance(now)
        result = rows if result is None else result.unionByName(rows)
    return result


def _values(spark, sf):
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("key"), F.round(F.col("value") * 100).cast("long").alias("value"), "event_id")


def _state(spark, sf):
    """State of the even users, from the earlier half of the events."""
    empty = spark.createDataFrame([], "key string, low bigint, high bigint")
    seen = _values(spark, sf).where("CAST(key AS BIGINT) % 2 = 0 AND event_id % 2 = 0")
    state = expand(empty, seen)
    return state.withColumn("low", F.when(F.col("key").cast("long") % 3 != 0, F.col("low")))


_STATE = """v AS (SELECT CAST(user_id AS VARCHAR) AS key, CAST(round(value * 100) AS BIGINT) AS value, event_id FROM events),
state AS (SELECT key, CASE WHEN CAST(key AS BIGINT) % 3 <> 0 THEN min(value) END AS low, max(value) AS high FROM v
          WHERE CAST(key AS BIGINT) % 2 = 0 AND event_id % 2 = 0 GROUP BY key)"""


@query("state_outside", f"""WITH {_STATE}
SELECT v.* FROM v LEFT JOIN state s ON v.key = s.key
WHERE s.key IS NULL OR coalesce(v.value > s.high, false) OR coalesce(v.value < s.low, false)""")
def state_outside(spark, sf):
    return outside_state(_values(spark, sf), _state(spark, sf))


@query("state_expand", f"""WITH {_STATE}, seen AS (SELECT key, min(value) AS lo, max(value) AS hi FROM v GROUP BY key)
SELECT coalesce(s.key, n.key) AS key, least(coalesce(s.low, lo), lo) AS low, greatest(coalesce(s.high, hi), hi) AS high
FROM state s FULL JOIN seen n ON s.key = n.key""")
def state_expand(spark, sf):
    return expand(_state(spark, sf), _values(spark, sf))


@query("state_stored", """
SELECT CAST(user_id AS VARCHAR) AS key, min(CAST(round(value * 100) AS BIGINT)) AS low, max(CAST(round(value * 100) AS BIGINT)) AS high
FROM events GROUP BY 1""")
def state_stored(spark, sf):
    """Three batches widen the stored state one after another; a batch that comes again changes nothing."""
    store = StateStore(spark, scratch_path(spark, "state"))
    for number in (0, 1, 1, 2):
        store.commit(expand(store.load(), _values(spark, sf).where(F.col("event_id") % 3 == number)), number)
    return store.load()


@query("buffered_upsert", """
SELECT CAST(user_id AS VARCHAR) AS external_id, arg_max(event_type, event_id) AS type, arg_max(value, event_id) AS value
FROM events GROUP BY 1""")
def buffered_upsert(spark, sf):
    """The event stream upserted into a table keyed by user; the last event wins."""
    rows = _stream(spark, sf).select(F.col("user_id").cast("string").alias("external_id"), "type", "value", "event_id")
    sink = MergeSink(VersionedTable(spark, scratch_path(spark, "upserted")), MergeSpec(), order_by=("event_id",))
    query = buffered_upload(rows, sink, scratch_path(spark, "upserted-progress"), interval_ms=None)
    query.awaitTermination()
    return sink.table.read()


@query("bucketed_flush", """
SELECT CAST(user_id AS VARCHAR) AS external_id, arg_max(event_type, n) AS type, arg_max(value, n) AS value
FROM (SELECT *, row_number() OVER () AS n FROM events) GROUP BY 1""")
def bucketed_flush(spark, sf):
    """As buffered_upsert, into hash buckets; the last event in the order of the file wins."""
    schema = table(spark, sf, "events").schema
    rows = with_position(file_stream(spark, f"{sf}/event[s].parquet", schema), newest_file_last=True).select(
        F.col("user_id").cast("string").alias("external_id"), F.col("event_type").alias("type"), "value", POSITION)
    target = BucketedTable(spark, scratch_path(spark, "flushed"), ["external_id"])
    buffered_upload(rows, MergeSink(target, MergeSpec()), scratch_path(spark, "flushed-progress"), interval_ms=None).awaitTermination()
    return target.read()


@query("stream_point_agg", """
SELECT user_id AS series_id, epoch_us(ts) // 1000 // 86400000 * 86400000 AS window_start, count(value) AS "count",
       round(sum(value), 4) AS "sum", min(value) AS "min", max(value) AS "max" FROM events GROUP BY ALL""")
def stream_point_agg(spark, sf):
    """Daily aggregates of the stream; the last update of each window counts."""
    schema = table(spark, sf, "events").schema
    rows = file_stream(spark, f"{sf}/event[s].parquet", schema).select(
        F.col("user_id").alias("series_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("value_num"))
    out = scratch_path(spark, "windows")
    progress = scratch_path(spark, "windows-progress")
    updates = stream_aggregates(rows, "1d", "30 seconds")
    query = updates.writeStream.outputMode("update").option("checkpointLocation", progress).foreachBatch(
        lambda batch, n: batch.withColumn("batch", F.lit(n)).write.mode("append").parquet(out)
    ).trigger(availableNow=True).start()
    query.awaitTermination()
    keys = ["series_id", "window_start"]
    last = spark.read.parquet(out).groupBy(*keys).agg(
        *[F.max_by(c, "batch").alias(c) for c in ("count", "sum", "min", "max")])
    return last.withColumn("sum", F.round("sum", 4))


F0, F1 = 852_076_800_000, 915_148_800_000
_SUBTREE = f"""WITH RECURSIVE {ASSETS},
sub AS (SELECT external_id, id FROM assets WHERE external_id IN ('R1', 'N7')
        UNION SELECT a.external_id, a.id FROM assets a JOIN sub s ON a.parent_external_id = s.external_id),
{EVENTS}
SELECT external_id, start_time FROM ev WHERE asset_id + 10000 IN (SELECT id FROM sub)"""
_ROOTS = {"assetSubtreeIds": [{"externalId": "R1"}, {"externalId": "N7"}]}


def _linked(spark, sf):
    return events(spark, sf).withColumn("asset_ids", F.transform("asset_ids", lambda a: (a + 10000).cast("long")))


@query("stream_subtree_filter", _SUBTREE + f" AND start_time >= {F0} AND start_time <= {F1}")
def stream_subtree_filter(spark, sf):
    """Two polls with a filter that reads the asset table."""
    reader = ChangeReader(lambda: _linked(spark, sf), _ROOTS, F0, F1, time_column="start_time",
                          lookups=lambda: {"assets": assets(spark, sf)})
    middle = (F0 + F1) // 2
    first = reader.poll(middle)
    reader.advance(middle)
    return first.unionByName(reader.poll(F1 + 10_000_000)).select("external_id", "start_time")


@query("stream_batches_subtree", _SUBTREE)
def stream_batches_subtree(spark, sf):
    """The same filter on the micro-batches of a file stream."""
    source, out = scratch_path(spark, "linked"), scratch_path(spark, "subtree")
    _linked(spark, sf).select("external_id", "start_time", "asset_ids").write.parquet(source)
    rows = file_stream(spark, source, spark.read.parquet(source).schema)
    run_stream(rows, lambda batch, n: batch.write.mode("append").parquet(out), scratch_path(spark, "subtree-progress"),
               filter=_ROOTS, lookups=lambda: {"assets": assets(spark, sf)}).awaitTermination()
    return spark.read.parquet(out).select("external_id", "start_time")


@query("raw_change_windows", f"""WITH {RAW} SELECT key, last_updated_time FROM raw
WHERE last_updated_time >= 1704153600000 AND last_updated_time <= 1704758400000 - 2000""")
def raw_change_windows(spark, sf):
    """Polls of a staging table, with its shorter offset."""
    from millrace.sources.raw import parse_raw_rows

    rows, _ = parse_raw_rows(raw_json(spark, sf), "plant", "log")
    reader = raw_changes(lambda: rows, "plant", "log", start_ms=1_704_153_600_000)
    first = reader.poll(1_704_400_000_000)
    reader.advance(1_704_400_000_000)
    return first.unionByName(reader.poll(1_704_758_400_000)).select("key", "last_updated_time")
