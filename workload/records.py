"""Raw rows, dynamic values and sequences."""

from pyspark.sql import functions as F

from millrace.functions.values import (
    struct_delimited, struct_strings, value_to_boolean, value_to_double, value_to_long, value_to_string,
)
from millrace.lineage import materialize
from millrace.operators.sequences import (
    delete_rows, extend_header, read_rows, schema_diff, to_long, to_wide, upsert_rows,
)
from millrace.sources.raw import parse_raw_rows, raw_delete, raw_upsert, relabel, typed_rows
from workload.mapping import RAW, SEQUENCES, raw_json, sequence_cells, table
from workload.registry import query


def _raw(spark, sf):
    return parse_raw_rows(raw_json(spark, sf), "plant", "log")[0]


def _field(name):
    return F.try_variant_get("columns", f"$['{name}']", "variant")


@query("raw_typed", f"""WITH {RAW}
SELECT key, name AS name_text, CAST(k AS VARCHAR) || '.0' AS k_text, CAST(k AS DOUBLE) AS k_double,
       CAST(floor(k - 50.5 + 0.5) AS BIGINT) AS half_long, event_id % 2 = 0 AS flag, user_id % 2 = 1 AS one,
       CAST(user_id AS BIGINT) AS digits, 'null' AS none_text, '' AS absent_text FROM raw""")
def raw_typed(spark, sf):
    return _raw(spark, sf).select(
        "key", value_to_string(_field("name")).alias("name_text"), value_to_string(_field("k")).alias("k_text"),
        value_to_double(_field("k"), strict=True).alias("k_double"), value_to_long(_field("half")).alias("half_long"),
        value_to_boolean(_field("flag")).alias("flag"), value_to_boolean(_field("one")).alias("one"),
        value_to_long(_field("digits")).alias("digits"), value_to_string(_field("none")).alias("none_text"),
        value_to_string(_field("absent")).alias("absent_text"))


@query("struct_path_list", f"""WITH {RAW}
SELECT key, name || ',a,' || k || '.0' AS status, CAST(3 AS BIGINT) AS n, '' AS missing FROM raw""")
def struct_path_list(spark, sf):
    status = struct_strings(F.col("columns"), ["nested", "results", "status"])
    return _raw(spark, sf).select(
        "key", F.array_join(status, ",").alias("status"), F.size(status).cast("long").alias("n"),
        struct_delimited(F.col("columns"), "nested.nothing.status", ";").alias("missing"))


@query("struct_path_nested", f"""WITH {RAW}
SELECT key, name || ',a [[x]' AS found FROM raw""")
def struct_path_nested(spark, sf):
    """Lists nested five deep in one another, with brackets inside a text."""
    column = lambda name: value_to_string(_field(name))
    json = F.to_json(F.struct(F.struct(column("name").alias("b")).alias("x")))
    inner = F.regexp_replace(json, '^[{]"x":|[}]$', "")
    text = F.concat(F.lit('{"a":[[[[['), inner, F.lit(',{"b":"a [[x]"}]]],[]],{"c":1}]}'))
    rows = _raw(spark, sf).select("key", F.parse_json(text).alias("v"))
    return rows.select("key", F.array_join(struct_strings(F.col("v"), ["a", "b"]), ",").alias("found"))


@query("raw_rejects", """
SELECT CASE WHEN p_partkey % 5 = 1 THEN 'key is not text' WHEN p_partkey % 5 = 2 THEN 'lastUpdatedTime is not a whole number'
            WHEN p_partkey % 5 = 3 THEN 'columns is not an object' ELSE 'not JSON' END AS reason, count(*) AS n
FROM part WHERE p_partkey % 5 <> 0 GROUP BY 1""")
def raw_rejects(spark, sf):
    k = F.col("p_partkey")
    text = k.cast("string")
    line = (
        F.when(k % 5 == 0, F.concat(F.lit('{"key":"'), text, F.lit('","lastUpdatedTime":5,"columns":{}}')))
        .when(k % 5 == 1, F.concat(F.lit('{"key":'), text, F.lit(',"lastUpdatedTime":5,"columns":{}}')))
        .when(k % 5 == 2, F.concat(F.lit('{"key":"'), text, F.lit('","lastUpdatedTime":5.5,"columns":{}}')))
        .when(k % 5 == 3, F.concat(F.lit('{"key":"'), text, F.lit('","lastUpdatedTime":5,"columns":[1]}')))
        .otherwise(F.concat(F.lit('{"key":"'), text))
    )
    _, rejects = parse_raw_rows(table(spark, sf, "part").select(line.alias("value")), "plant", "parts")
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("raw_upserted", f"""WITH {RAW}
SELECT 'copy' AS table_name, key, CASE WHEN event_id % 3 = 0 THEN 'again' ELSE name END AS name FROM raw WHERE event_id % 10 <> 9""")
def raw_upserted(spark, sf):
    rows = materialize(relabel(_raw(spark, sf), table="copy"), "raw")  # read four times, parsed once
    number = F.col("key").cast("long")
    newer = rows.where(number % 3 == 0).select(
        "db_name", "table_name", "key", (F.col("last_updated_time") + 1).alias("last_updated_time"),
        F.parse_json(F.lit('{"name":"again"}')).alias("columns"))
    after = raw_upsert(rows, newer.unionByName(rows.where(number % 3 == 0)))
    left = raw_delete(after.drop("_change"), rows.where(number % 10 == 9))
    return left.select("table_name", "key", value_to_string(F.try_variant_get("columns", "$.name", "variant")).alias("name"))


@query("typed_ingest", """
SELECT event_id AS id, event_type AS type, value AS amount FROM events WHERE event_id % 4 <> 0""")
def typed_ingest(spark, sf):
    line = F.to_json(F.struct(
        F.when(F.col("event_id") % 4 != 0, F.col("event_id")).alias("id"), F.col("event_type").alias("type"),
        F.col("value").alias("amount")))
    rows, _ = typed_rows(table(spark, sf, "events").select(line.alias("value")), "id bigint, type string, amount double", ["id"])
    return rows


# ------------------------------------------------------------------ sequences

WIDE = {"quantity": "LONG", "price": "DOUBLE", "flag": "STRING"}


@query("sequence_wide", f"WITH {SEQUENCES} SELECT * FROM seq")
def sequence_wide(spark, sf):
    return to_wide(sequence_cells(spark, sf), WIDE)


@query("sequence_window", f"WITH {SEQUENCES} SELECT external_id, row_number, quantity, price FROM seq WHERE row_number >= 2 AND row_number < 5")
def sequence_window(spark, sf):
    cells = read_rows(sequence_cells(spark, sf), 2, 5, ["quantity", "price"])
    return to_wide(cells, {k: WIDE[k] for k in ("quantity", "price")})


@query("sequence_typed_bodies", """
SELECT CAST(o_orderkey AS VARCHAR) AS external_id, CAST(trunc(o_totalprice) AS BIGINT) AS whole, o_totalprice AS price,
       o_orderstatus AS status FROM orders""")
def sequence_typed_bodies(spark, sf):
    """One-row bodies with positional values, typed by their columns and laid out wide."""
    column = lambda name, kind: F.struct(F.lit(name).alias("external_id"), F.lit(kind).alias("value_type"))
    as_variant = lambda c: F.parse_json(F.to_json(F.struct(c.alias("v"))))
    item = lambda c: F.variant_get(as_variant(c), "$.v", "variant")
    bodies = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("external_id"), F.lit(0).cast("long").alias("row_number"),
        F.array(column("whole", "LONG"), column("price", "DOUBLE"), column("status", "STRING")).alias("columns"),
        F.array(item(F.col("o_totalprice")), item(F.col("o_totalprice")), item(F.col("o_orderstatus"))).alias("values"))
    wide = to_wide(to_long(bodies), {"whole": "LONG", "price": "DOUBLE", "status": "STRING"})
    return wide.drop("row_number")


def _headers(spark, sf):
    k = F.col("p_partkey")
    col = lambda name, kind: F.struct(F.lit(name).alias("column_id"), kind.alias("value_type"))
    d, s = F.lit("DOUBLE"), F.lit("STRING")
    explode = lambda *cols: table(spark, sf, "part").select(
        k.cast("string").alias("external_id"), F.explode(F.filter(F.array(*cols), lambda c: c.isNotNull())).alias("c")
    ).select("external_id", "c.*")
    old = explode(col("a", d), F.when(k % 2 == 0, col("b", s)), F.when(k % 3 == 0, col("c", d)))
    new = explode(col("a", F.when(k % 10 == 0, s).otherwise(d)), F.when(k % 4 == 0, col("b", s)), F.when(k % 5 == 0, col("d", d)))
    return new, old


@query("sequence_schema_diff", """
WITH old AS (SELECT p_partkey AS k, 'a' AS c, 'DOUBLE' AS t FROM part UNION ALL SELECT p_partkey, 'b', 'STRING' FROM part WHERE p_partkey % 2 = 0
             UNION ALL SELECT p_partkey, 'c', 'DOUBLE' FROM part WHERE p_partkey % 3 = 0),
new AS (SELECT p_partkey AS k, 'a' AS c, CASE WHEN p_partkey % 10 = 0 THEN 'STRING' ELSE 'DOUBLE' END AS t FROM part
        UNION ALL SELECT p_partkey, 'b', 'STRING' FROM part WHERE p_partkey % 4 = 0
        UNION ALL SELECT p_partkey, 'd', 'DOUBLE' FROM part WHERE p_partkey % 5 = 0)
SELECT CAST(coalesce(n.k, o.k) AS VARCHAR) AS external_id, coalesce(n.c, o.c) AS column_id,
       CASE WHEN o.k IS NULL THEN 'add' WHEN n.k IS NULL THEN 'remove' WHEN n.t = o.t THEN 'modify' ELSE 'type_conflict' END AS action
FROM new n FULL JOIN old o ON n.k = o.k AND n.c = o.c""")
def sequence_schema_diff(spark, sf):
    new, old = _headers(spark, sf)
    return schema_diff(new, old, replace=True, strict=False)


@query("sequence_header_extended", f"""WITH {SEQUENCES}, used AS (SELECT DISTINCT external_id FROM seq)
SELECT external_id, c AS column_id, CASE c WHEN 'flag' THEN 'STRING' ELSE 'DOUBLE' END AS value_type
FROM used, (SELECT unnest(['quantity', 'price', 'flag']) AS c)""")
def sequence_header_extended(spark, sf):
    cells = sequence_cells(spark, sf)
    header = cells.where("column_id = 'price' AND CAST(external_id AS BIGINT) % 2 = 0").select(
        "external_id", "column_id", "value_type").distinct()
    return extend_header(cells, header)


@query("sequence_delete_rows", f"WITH {SEQUENCES} SELECT external_id, row_number, quantity FROM seq WHERE NOT (row_number IN (1, 3) AND CAST(external_id AS BIGINT) % 2 = 0)")
def sequence_delete_rows(spark, sf):
    wanted = table(spark, sf, "orders").where("o_orderkey % 2 = 0").select(
        F.col("o_orderkey").cast("string").alias("external_id"), F.array(F.lit(1), F.lit(3), F.lit(1)).cast("array<bigint>").alias("row_numbers"))
    left = delete_rows(sequence_cells(spark, sf).where("column_id = 'quantity'"), wanted)
    return left.select("external_id", "row_number", F.col("value_num").cast("long").alias("quantity"))


@query("sequence_upsert_rows", f"""WITH {SEQUENCES}
SELECT external_id, row_number, CASE WHEN row_number % 2 = 0 THEN price * 2 ELSE price END AS price FROM seq
UNION ALL SELECT external_id, row_number + 100, price FROM seq WHERE row_number = 1""")
def sequence_upsert_rows(spark, sf):
    prices = sequence_cells(spark, sf).where("column_id = 'price'")
    doubled = prices.where("row_number % 2 = 0").withColumn("value_num", F.col("value_num") * 2)
    moved = prices.where("row_number = 1").withColumn("row_number", F.col("row_number") + 100)
    after = upsert_rows(prices, doubled.unionByName(moved))
    return after.select("external_id", "row_number", F.col("value_num").alias("price"))


@query("json_attributes", """
SELECT p_partkey AS id, p_name AS name, CAST(p_size AS VARCHAR) AS size,
       '{"a":' || p_size || ',"b":["' || p_brand || '"]}' AS nested, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS brand FROM part""")
def json_attributes(spark, sf):
    """Attributes of payloads: text as it is, numbers as text, containers as JSON."""
    from millrace.functions.values import json_attribute

    size = F.col("p_size").cast("int")
    payload = F.to_json(F.struct(
        F.col("p_name").alias("name"), F.struct(size.alias("size"), F.struct(size.alias("a"), F.array("p_brand").alias("b")).alias("nested")).alias("x"),
        F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).alias("brand")))
    rows = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), payload.alias("j"))
    read = lambda *path: json_attribute(F.col("j"), path)
    return rows.select("id", read("name").alias("name"), read("x", "size").alias("size"), read("x", "nested").alias("nested"), read("brand").alias("brand"))
