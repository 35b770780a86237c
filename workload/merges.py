"""Upserts, dedupes, deletes and transformations."""

from functools import reduce

from pyspark.sql import functions as F

from millrace.lineage import scratch_path
from millrace.operators.merge import (
    REPLACE, SPECS, UPDATE, delete_keys, last_write_wins, merge, split_upsert, write_volume,
)
from millrace.plans.transform import TransformationRunner, apply_rows
from millrace.sources.buckets import BucketedTable
from millrace.sources.files import upload
from millrace.sources.order import with_position
from millrace.workspace import Workspace
from workload.mapping import EVENTS, events, map_text, table
from workload.registry import query

COLUMNS = ["external_id", "type", "subtype", "description", "source", "start_time", "metadata"]


def target(spark, sf):
    """Every order except the multiples of 7."""
    return events(spark, sf).where("id % 7 <> 0").select(*COLUMNS)


def edits(spark, sf):
    """A partial row for every multiple of 5, and a new row for every multiple of 50."""
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").where((k % 5 == 0)).select(
        F.explode(F.array(k, F.when(k % 50 == 0, k + 100_000_000))).alias("k"), "o_totalprice"
    ).where("k IS NOT NULL").select(
        F.col("k").cast("string").alias("external_id"), F.lit("X").alias("type"), F.lit(None).cast("string").alias("subtype"),
        F.when(F.col("k") % 3 == 0, F.concat(F.lit("edit "), F.col("k").cast("string"))).alias("description"),
        F.when(F.col("k") % 2 == 0, F.create_map(F.lit("band"), F.lit("new"), F.lit("edit"), F.lit("yes"))).alias("metadata"),
    )


_BOTH = f"""WITH {EVENTS},
tgt AS (SELECT external_id, type, subtype, description, source, start_time, band, subtype AS priority FROM ev WHERE id % 7 <> 0),
keys AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 5 = 0
         UNION ALL SELECT o_orderkey + 100000000 FROM orders WHERE o_orderkey % 50 = 0),
src AS (SELECT CAST(k AS VARCHAR) AS external_id, 'X' AS type, CAST(NULL AS VARCHAR) AS subtype,
               CASE WHEN k % 3 = 0 THEN 'edit ' || k END AS description, k % 2 = 0 AS has_meta FROM keys)
"""


@query("merge_update", _BOTH + """
SELECT coalesce(t.external_id, s.external_id) AS external_id, coalesce(s.type, t.type) AS type, t.subtype,
       coalesce(s.description, t.description) AS description, t.source, t.start_time,
       CASE WHEN t.external_id IS NULL THEN CASE WHEN has_meta THEN 'band=new;edit=yes' END
            WHEN s.external_id IS NOT NULL AND has_meta THEN 'band=new;edit=yes;priority=' || t.priority
            ELSE 'band=' || t.band || ';priority=' || t.priority END AS metadata,
       CASE WHEN t.external_id IS NULL THEN 'created' WHEN s.external_id IS NULL THEN 'untouched' ELSE 'updated' END AS change
FROM tgt t FULL JOIN src s ON t.external_id = s.external_id""")
def merge_update(spark, sf):
    df = merge(target(spark, sf), edits(spark, sf), SPECS["events"], UPDATE)
    return df.withColumn("metadata", map_text(F.col("metadata"))).withColumnRenamed("_change", "change")


@query("merge_replace", _BOTH + """
SELECT coalesce(t.external_id, s.external_id) AS external_id,
       CASE WHEN s.external_id IS NULL THEN t.type ELSE s.type END AS type,
       CASE WHEN s.external_id IS NULL THEN t.subtype END AS subtype,
       CASE WHEN s.external_id IS NULL THEN t.description ELSE s.description END AS description,
       CASE WHEN s.external_id IS NULL THEN t.source END AS source,
       CASE WHEN s.external_id IS NULL THEN t.start_time END AS start_time,
       CASE WHEN s.external_id IS NULL THEN 'band=' || t.band || ';priority=' || t.priority
            WHEN has_meta THEN 'band=new;edit=yes' WHEN t.external_id IS NOT NULL THEN '' END AS metadata
FROM tgt t FULL JOIN src s ON t.external_id = s.external_id""")
def merge_replace(spark, sf):
    df = merge(target(spark, sf), edits(spark, sf), SPECS["events"], REPLACE).drop("_change")
    return df.withColumn("metadata", map_text(F.col("metadata")))


@query("merge_timeseries_unit", """
SELECT CAST(p_partkey AS VARCHAR) AS external_id, p_name AS name,
       CASE WHEN p_partkey % 2 = 0 THEN CASE WHEN p_partkey % 4 = 0 THEN 'bar' END ELSE p_type END AS unit,
       CASE WHEN p_partkey % 6 = 0 THEN NULL WHEN p_partkey % 10 = 0 THEN 'u:new' ELSE 'u:' || p_type END AS unit_external_id,
       p_size % 2 = 0 AS is_step
FROM part""")
def merge_timeseries_unit(spark, sf):
    """Unit clears when absent; the unit reference only when blank; the step flag never changes."""
    k = F.col("p_partkey")
    old = table(spark, sf, "part").select(
        k.cast("string").alias("external_id"), F.col("p_name").alias("name"), F.col("p_type").alias("unit"),
        F.concat(F.lit("u:"), "p_type").alias("unit_external_id"), (F.col("p_size") % 2 == 0).alias("is_step"))
    new = table(spark, sf, "part").where(k % 2 == 0).select(
        k.cast("string").alias("external_id"),
        F.when(k % 4 == 0, F.lit("bar")).when(k % 8 == 2, F.lit(" ")).alias("unit"),
        F.when(k % 6 == 0, F.lit(" ")).when(k % 10 == 0, F.lit("u:new")).alias("unit_external_id"),
        F.lit(True).alias("is_step"))
    return merge(old, new, SPECS["timeseries"]).drop("_change")


@query("merge_dedupe_last", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1""")
def merge_dedupe_last(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    latest = last_write_wins(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"])
    return latest.drop("l_shipdate")


@query("upsert_input_order", """
WITH l AS (SELECT *, row_number() OVER () AS n FROM lineitem)
SELECT l_partkey AS part, arg_max(l_orderkey, n) AS last_order, arg_max(l_quantity, n) AS last_quantity,
       arg_min(l_orderkey, n) AS first_order, arg_min(l_quantity, n) AS first_quantity FROM l GROUP BY l_partkey""")
def upsert_input_order(spark, sf):
    """The last line of each part in the order of the file, and that of the reversed file, which is the first."""
    lines = with_position(table(spark, sf, "lineitem").select(F.col("l_partkey").alias("part"), "l_orderkey", "l_quantity"))
    back = lines.withColumn("_position", F.struct((-F.col("_position.row")).alias("row")))
    last = last_write_wins(lines, ["part"]).select("part", F.col("l_orderkey").alias("last_order"), F.col("l_quantity").alias("last_quantity"))
    first = last_write_wins(back, ["part"]).select("part", F.col("l_orderkey").alias("first_order"), F.col("l_quantity").alias("first_quantity"))
    return last.join(first, "part")


def _stored(spark, sf):
    """A workspace that holds the target events in buckets."""
    ws = Workspace(spark, scratch_path(spark, "buckets"))
    ws.events.create(target(spark, sf))
    return ws


@query("bucketed_upsert", _BOTH + """
SELECT coalesce(t.external_id, s.external_id) AS external_id, coalesce(s.type, t.type) AS type, t.subtype,
       coalesce(s.description, t.description) AS description, t.source, t.start_time,
       CASE WHEN t.external_id IS NULL THEN CASE WHEN has_meta THEN 'band=new;edit=yes' END
            WHEN s.external_id IS NOT NULL AND has_meta THEN 'band=new;edit=yes;priority=' || t.priority
            ELSE 'band=' || t.band || ';priority=' || t.priority END AS metadata
FROM tgt t FULL JOIN src s ON t.external_id = s.external_id""")
def bucketed_upsert(spark, sf):
    """The edits of merge_update, written into buckets and read back."""
    ws = _stored(spark, sf)
    ws.events.upsert(edits(spark, sf))
    return ws.events.list().withColumn("metadata", map_text(F.col("metadata")))


@query("bucketed_delete", _BOTH + """
SELECT external_id, type, source FROM tgt WHERE external_id NOT IN (SELECT external_id FROM src)""")
def bucketed_delete(spark, sf):
    ws = _stored(spark, sf)
    ws.events.delete(edits(spark, sf).select("external_id"))
    return ws.events.list().select("external_id", "type", "source")


@query("bucketed_slices", _BOTH + "SELECT external_id, type, source FROM tgt")
def bucketed_slices(spark, sf):
    """Five slices of the stored events, each of whole buckets, together hold every row once."""
    ws = _stored(spark, sf)
    parts = [ws.events.list(slice=f"{i}/5").select("external_id", "type", "source") for i in range(1, 6)]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("upsert_split", _BOTH + """
SELECT s.external_id, CASE WHEN t.external_id IS NULL THEN 'create' ELSE 'update' END AS action
FROM src s LEFT JOIN tgt t ON s.external_id = t.external_id""")
def upsert_split(spark, sf):
    creates, updates = split_upsert(target(spark, sf), edits(spark, sf), ["external_id"])
    pick = lambda df, a: df.select("external_id", F.lit(a).alias("action"))
    return pick(creates, "create").unionByName(pick(updates, "update"))


@query("delete_keys", f"""WITH {EVENTS}
SELECT external_id, price FROM ev WHERE id NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def delete_by_key(spark, sf):
    gone = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").cast("string").alias("external_id"))
    remaining, _ = delete_keys(events(spark, sf).select("external_id", "price"), gone, ["external_id"])
    return remaining


@query("write_volume", """
SELECT count(*) AS "rows", count(*) * 3 AS cells, CAST(sum(length(lang) + length(source) + length(text)) AS BIGINT) AS characters,
       CAST(sum(octet_length(encode(lang)) + octet_length(encode(source)) + octet_length(encode(text))) AS BIGINT) AS bytes FROM documents""")
def volume(spark, sf):
    return write_volume(table(spark, sf, "documents"), ["lang", "source", "text"])


# -------------------------------------------------------------- transformations

_TGT = _BOTH


def _view(spark, sf, only: str | None = None):
    """The query side of a transformation: plain SQL over registered raw views."""
    edits(spark, sf).createOrReplaceTempView("raw_edits")
    return spark.sql("SELECT external_id, type, description FROM raw_edits" + (f" WHERE {only}" if only else ""))


def _target(spark, sf):
    return target(spark, sf).select("external_id", "type", "description", "source")


@query("transform_abort", _TGT + """
SELECT external_id, type, description, source FROM tgt
UNION ALL SELECT external_id, type, description, NULL FROM src WHERE CAST(external_id AS BIGINT) >= 100000000""")
def transform_abort(spark, sf):
    rows = _view(spark, sf, "CAST(external_id AS BIGINT) >= 100000000")
    return apply_rows(_target(spark, sf), rows, "events", "abort").drop("_change")


@query("transform_upsert", _TGT + """
SELECT coalesce(t.external_id, s.external_id) AS external_id, coalesce(s.type, t.type) AS type,
       coalesce(s.description, t.description) AS description, t.source
FROM tgt t FULL JOIN src s ON t.external_id = s.external_id""")
def transform_upsert(spark, sf):
    return apply_rows(_target(spark, sf), _view(spark, sf), "events", "upsert").drop("_change")


@query("transform_update", _TGT + """
SELECT t.external_id, coalesce(s.type, t.type) AS type,
       CASE WHEN s.external_id IS NULL THEN t.description ELSE s.description END AS description, t.source
FROM tgt t LEFT JOIN src s ON t.external_id = s.external_id""")
def transform_update(spark, sf):
    """Nulls of the query overwrite here, as ``ignore_nulls`` is off; ``source`` is not selected at all."""
    return apply_rows(_target(spark, sf), _view(spark, sf), "events", "update", ignore_nulls=False).drop("_change")


@query("transform_delete", _TGT + """
SELECT external_id, type, description, source FROM tgt WHERE external_id NOT IN (SELECT external_id FROM src)""")
def transform_delete(spark, sf):
    df = apply_rows(_target(spark, sf), _view(spark, sf).select("external_id"), "events", "delete")
    return df.where("_change <> 'deleted'").drop("_change")


@query("labels_merged", """
WITH old AS (SELECT p_partkey AS k, 'name ' || p_partkey AS name, 'about ' || p_partkey AS description FROM part WHERE p_partkey % 3 <> 0),
new AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 2 = 0 THEN 'new ' || p_partkey END AS name FROM part WHERE p_partkey % 5 = 0)
SELECT 'L' || coalesce(o.k, n.k) AS external_id, CASE WHEN n.k IS NOT NULL THEN n.name ELSE o.name END AS name,
       CASE WHEN n.k IS NULL THEN o.description END AS description FROM old o FULL JOIN new n ON o.k = n.k""")
def labels_merged(spark, sf):
    k = F.col("p_partkey")
    part = table(spark, sf, "part")
    name = lambda c: F.concat(F.lit("L"), c.cast("string")).alias("external_id")
    old = part.where(k % 3 != 0).select(name(k), F.concat(F.lit("name "), k).alias("name"),
                                        F.concat(F.lit("about "), k).alias("description"), F.lit(1).cast("long").alias("data_set_id"))
    new = part.where(k % 5 == 0).select(name(k), F.when(k % 2 == 0, F.concat(F.lit("new "), k)).alias("name"),
                                        F.lit(None).cast("string").alias("description"), F.lit(2).cast("long").alias("data_set_id"))
    return merge(old, new, SPECS["labels"], UPDATE).select("external_id", "name", "description")


@query("files_merged", """
WITH old AS (SELECT p_partkey AS k FROM part WHERE p_partkey % 3 <> 0), new AS (SELECT p_partkey AS k FROM part WHERE p_partkey % 5 = 0)
SELECT 'F' || coalesce(o.k, n.k) AS external_id, CASE WHEN o.k IS NULL THEN 'new name' ELSE 'old name' END AS name,
       CASE WHEN o.k IS NULL THEN 'b' WHEN n.k IS NULL THEN 'a' WHEN o.k % 2 = 0 THEN 'a,b' ELSE 'a,b' END AS labels FROM old o FULL JOIN new n ON o.k = n.k""")
def files_merged(spark, sf):
    """Labels are added, a name stays as it was made."""
    k = F.col("p_partkey")
    part = table(spark, sf, "part")
    shaped = lambda rows, name, label: rows.select(
        F.concat(F.lit("F"), k.cast("string")).alias("external_id"), F.lit(name).alias("name"), F.array(F.lit(label)).alias("labels"))
    after = merge(shaped(part.where(k % 3 != 0), "old name", "a"), shaped(part.where(k % 5 == 0), "new name", "b"), SPECS["files"], UPDATE)
    return after.select("external_id", "name", F.array_join("labels", ",").alias("labels"))


@query("files_uploaded", """
SELECT CAST(doc_id AS VARCHAR) AS external_id, CASE WHEN doc_id % 2 = 0 THEN 'old' ELSE source END AS name, true AS uploaded,
       CAST(octet_length(encode(text)) AS BIGINT) AS content_length FROM documents""")
def files_uploaded(spark, sf):
    """Contents written over known files, whose names stay, and new ones; the longer of two contents of a key comes last."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("external_id"), "doc_id", "source", "text")
    known = docs.where("doc_id % 2 = 0").select(
        "external_id", F.lit("old").alias("name"), F.lit(False).alias("uploaded"), F.lit(None).cast("long").alias("content_length"))
    whole = docs.select("external_id", F.col("source").alias("name"), F.col("text").cast("binary").alias("content"), F.lit(1).alias("turn"))
    part = docs.select("external_id", F.col("source").alias("name"), F.substring("text", 1, 10).cast("binary").alias("content"), F.lit(0).alias("turn"))
    return upload(known, whole.union(part), ["turn"]).drop("_change")


_KINDS = ("timeseries", "labels", "files", "sequences", "data_sets", "assets", "relationships")


@query("transform_destinations", """
WITH old AS (SELECT p_partkey AS k FROM part WHERE p_partkey % 3 <> 0),
new AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 4 <> 0 THEN 'new ' || p_partkey END AS name FROM part WHERE p_partkey % 2 = 0),
kinds AS (SELECT unnest(['timeseries', 'labels', 'files', 'sequences', 'data_sets', 'assets', 'relationships']) AS kind)
SELECT kind, CAST(k AS VARCHAR) AS external_id, CASE WHEN is_new IS NULL THEN 'old' WHEN is_old IS NULL OR kind = 'labels' THEN name
       WHEN kind = 'files' THEN 'old' ELSE coalesce(name, 'old') END AS name,
       CASE WHEN is_new IS NULL THEN 'untouched' WHEN is_old IS NULL THEN 'created' ELSE 'updated' END AS change
FROM kinds, (SELECT coalesce(o.k, n.k) AS k, o.k AS is_old, n.k AS is_new, n.name FROM old o FULL JOIN new n ON o.k = n.k)""")
def transform_destinations(spark, sf):
    """The same rows upserted into seven destinations, each by its own rules for a name."""
    k = F.col("p_partkey")
    part = table(spark, sf, "part")
    old = part.where(k % 3 != 0).select(k.cast("string").alias("external_id"), F.lit("old").alias("name"))
    new = part.where(k % 2 == 0).select(k.cast("string").alias("external_id"), F.when(k % 4 != 0, F.concat(F.lit("new "), k.cast("string"))).alias("name"))
    done = [apply_rows(old, new, kind, "upsert").select(F.lit(kind).alias("kind"), "external_id", "name", F.col("_change").alias("change"))
            for kind in _KINDS]
    return reduce(lambda a, b: a.unionByName(b), done)


@query("transform_job_metrics", _TGT + """
SELECT 'read' AS name, count(*) AS "count" FROM src
UNION ALL SELECT 'created', count(*) FROM src WHERE external_id NOT IN (SELECT external_id FROM tgt)
UNION ALL SELECT 'updated', count(*) FROM src WHERE external_id IN (SELECT external_id FROM tgt)
UNION ALL SELECT 'deleted', 0""")
def transform_job_metrics(spark, sf):
    """A transformation run into a bucketed table, and the counts that its job logged."""
    stored = BucketedTable(spark, scratch_path(spark, "transformed"), ["external_id"])
    stored.commit(_target(spark, sf))
    runner = TransformationRunner(spark, scratch_path(spark, "jobs"))
    job = runner.run("edits", _view(spark, sf), stored, "events")
    return runner.metrics(job.job_id).select("name", "count")
