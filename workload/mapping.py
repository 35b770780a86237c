"""The test tables seen as resource tables, and the same views as SQL text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions.durations import DAY_MS, epoch_ms


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def map_text(column: Column) -> Column:
    """A map as ``k=v;...`` in key order."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(column)),
                                    lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")


# ------------------------------------------------------------------------ points

def points(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("user_id").alias("series_id"), epoch_ms(F.col("ts")).alias("ts_ms"),
        F.col("value").alias("value_num"), F.col("event_type").alias("value_string"),
        (F.col("user_id") % 2 == 1).alias("is_step"),
    )


POINTS = """points AS (
  SELECT user_id AS series_id, epoch_us(ts) // 1000 AS ts_ms, value AS value_num, event_type AS value_string,
         user_id % 2 = 1 AS is_step
  FROM events)"""


# ------------------------------------------------------------------------ events

def events(spark, sf) -> DataFrame:
    k = F.col("o_orderkey")
    day = epoch_ms(F.col("o_orderdate"))
    text = lambda c: c.cast("string")
    return table(spark, sf, "orders").select(
        k.alias("id"), text(k).alias("external_id"),
        F.when(k % 13 != 0, day).alias("start_time"),
        F.when(k % 10 != 0, day + (k % 90) * DAY_MS).alias("end_time"),
        F.col("o_orderstatus").alias("type"), F.col("o_orderpriority").alias("subtype"),
        F.concat(F.lit("order "), text(k)).alias("description"),
        F.concat(F.lit("src"), text(k % 4)).alias("source"),
        F.array("o_custkey").alias("asset_ids"),
        F.array(F.concat(F.lit("L"), text(k % 3)), F.concat(F.lit("M"), text(k % 5))).alias("labels"),
        F.create_map(F.lit("band"), text(k % 7), F.lit("priority"), F.col("o_orderpriority")).alias("metadata"),
        (k % 6).alias("data_set_id"),
        (day + k % 1000).alias("last_updated_time"),
        F.col("o_totalprice").alias("price"),
    )


EVENTS = f"""ev AS (
  SELECT o_orderkey AS id, CAST(o_orderkey AS VARCHAR) AS external_id,
         CASE WHEN o_orderkey % 13 <> 0 THEN epoch_ms(o_orderdate) END AS start_time,
         CASE WHEN o_orderkey % 10 <> 0 THEN epoch_ms(o_orderdate) + (o_orderkey % 90) * {DAY_MS} END AS end_time,
         o_orderstatus AS type, o_orderpriority AS subtype,
         'order ' || CAST(o_orderkey AS VARCHAR) AS description,
         'src' || CAST(o_orderkey % 4 AS VARCHAR) AS source,
         o_custkey AS asset_id,
         ['L' || CAST(o_orderkey % 3 AS VARCHAR), 'M' || CAST(o_orderkey % 5 AS VARCHAR)] AS labels,
         CAST(o_orderkey % 7 AS VARCHAR) AS band, o_orderkey % 6 AS data_set_id,
         epoch_ms(o_orderdate) + o_orderkey % 1000 AS last_updated_time, o_totalprice AS price
  FROM orders)"""


# ------------------------------------------------------------------------ assets

ROOT = "ROOT"


def assets(spark, sf) -> DataFrame:
    text = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    none = F.lit(None).cast("string")
    row = lambda id_, ext, parent, name, source, size: [
        id_.cast("long").alias("id"), ext.alias("external_id"), parent.alias("parent_external_id"),
        name.alias("name"), none.alias("description"), F.lit(source).alias("source"),
        F.create_map(F.lit("size"), size).alias("metadata"), F.array(F.lit(source)).alias("labels"),
        F.lit(1).cast("long").alias("data_set_id"),
    ]
    root = spark.range(1).select(*row(F.lit(1), F.lit(ROOT), none, F.lit("world"), "world", F.lit("0")))
    regions = table(spark, sf, "region").select(
        *row(F.col("r_regionkey") + 100, text("R", "r_regionkey"), F.lit(ROOT), F.col("r_name"), "region", F.lit("1")))
    nations = table(spark, sf, "nation").select(
        *row(F.col("n_nationkey") + 1000, text("N", "n_nationkey"), text("R", "n_regionkey"), F.col("n_name"), "nation", F.lit("2")))
    customers = table(spark, sf, "customer").select(
        *row(F.col("c_custkey") + 10000, text("C", "c_custkey"), text("N", "c_nationkey"), F.col("c_name"),
             "customer", F.col("c_mktsegment")))
    return root.unionByName(regions).unionByName(nations).unionByName(customers)


ASSETS = """assets AS (
  SELECT CAST(1 AS BIGINT) AS id, 'ROOT' AS external_id, CAST(NULL AS VARCHAR) AS parent_external_id,
         'world' AS name, 'world' AS source, '0' AS size
  UNION ALL SELECT r_regionkey + 100, 'R' || r_regionkey, 'ROOT', r_name, 'region', '1' FROM region
  UNION ALL SELECT n_nationkey + 1000, 'N' || n_nationkey, 'R' || n_regionkey, n_name, 'nation', '2' FROM nation
  UNION ALL SELECT c_custkey + 10000, 'C' || c_custkey, 'N' || c_nationkey, c_name, 'customer', c_mktsegment FROM customer)"""


def faulty_assets(spark, sf) -> DataFrame:
    """The hierarchy with every kind of fault planted, as ``(external_id, parent_external_id)``."""
    k = F.col("c_custkey")
    name = lambda p: F.concat(F.lit(p), k.cast("string"))
    pair = lambda child, parent: F.struct(child.alias("external_id"), parent.alias("parent_external_id"))
    none = F.lit(None).cast("string")
    planted = F.array(
        F.when(k % 101 == 0, pair(none, F.lit(ROOT))),
        F.when(k % 97 == 0, pair(name("C"), F.concat(F.lit("N"), F.col("c_nationkey").cast("string")))),
        F.when(k % 103 == 0, pair(name("S"), name("S"))),
        F.when(k % 89 == 0, pair(name("A"), name("B"))),
        F.when(k % 89 == 0, pair(name("B"), name("A"))),
        F.when(k % 89 == 0, pair(name("T"), name("A"))),
        F.when(k % 79 == 0, pair(name("X"), name("Y"))),
        F.when(k % 79 == 0, pair(name("Y"), name("Z"))),
        F.when(k % 79 == 0, pair(name("Z"), name("X"))),
        F.when(k % 107 == 0, pair(name("D"), name("gone"))),
        F.when(k % 500 == 0, pair(name("ROOT"), F.lit(" "))),
    )
    extra = table(spark, sf, "customer").select(F.explode(F.filter(planted, lambda p: p.isNotNull())).alias("p")).select("p.*")
    return assets(spark, sf).select("external_id", "parent_external_id").unionByName(extra)


FAULTY = ASSETS + """, faulty AS (
  SELECT external_id, parent_external_id FROM assets
  UNION ALL SELECT NULL, 'ROOT' FROM customer WHERE c_custkey % 101 = 0
  UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey FROM customer WHERE c_custkey % 97 = 0
  UNION ALL SELECT 'S' || c_custkey, 'S' || c_custkey FROM customer WHERE c_custkey % 103 = 0
  UNION ALL SELECT 'A' || c_custkey, 'B' || c_custkey FROM customer WHERE c_custkey % 89 = 0
  UNION ALL SELECT 'B' || c_custkey, 'A' || c_custkey FROM customer WHERE c_custkey % 89 = 0
  UNION ALL SELECT 'T' || c_custkey, 'A' || c_custkey FROM customer WHERE c_custkey % 89 = 0
  UNION ALL SELECT 'X' || c_custkey, 'Y' || c_custkey FROM customer WHERE c_custkey % 79 = 0
  UNION ALL SELECT 'Y' || c_custkey, 'Z' || c_custkey FROM customer WHERE c_custkey % 79 = 0
  UNION ALL SELECT 'Z' || c_custkey, 'X' || c_custkey FROM customer WHERE c_custkey % 79 = 0
  UNION ALL SELECT 'D' || c_custkey, 'gone' || c_custkey FROM customer WHERE c_custkey % 107 = 0
  UNION ALL SELECT 'ROOT' || c_custkey, ' ' FROM customer WHERE c_custkey % 500 = 0)"""


# ------------------------------------------------------------------- 3D nodes

_REGION, _NATION, _TOP = 1 << 40, 1 << 33, 1 << 44


def nodes_3d(spark, sf) -> DataFrame:
    """The hierarchy as 3D nodes; tree indexes leave gaps, so every interval nests by arithmetic."""
    region, nation, customer = (table(spark, sf, t) for t in ("region", "nation", "customer"))
    long = lambda c: c.cast("long")
    base = lambda r, n: long(r) * _REGION + 2 + long(n) * _NATION
    box = lambda lo, hi: F.struct(F.array(*lo).alias("min"), F.array(*hi).alias("max"))
    no_box = F.lit(None).cast("struct<min:array<double>,max:array<double>>")
    kind = lambda t, req, p: F.create_map(
        F.lit("Item"), F.create_map(F.lit("Type"), t, F.lit("Required"), req),
        F.lit("PDMS"), F.create_map(F.lit("Type"), p))
    row = lambda node, name, parent, ti, size, depth, b, props: [
        F.lit(1).cast("long").alias("model_id"), F.lit(1).cast("long").alias("revision_id"),
        long(node).alias("node_id"), name.alias("name"), long(parent).alias("parent_id"),
        long(ti).alias("tree_index"), long(size).alias("subtree_size"), F.lit(depth).alias("depth"),
        b.alias("bounding_box"), props.alias("properties")]
    top = spark.range(1).select(*row(
        F.lit(1), F.lit("world"), F.lit(None), F.lit(0), F.lit(_TOP), 0, no_box,
        kind(F.lit("Group"), F.lit("true"), F.lit("WORL"))))
    regions = region.select(*row(
        F.col("r_regionkey") + 100, F.col("r_name"), F.lit(1), long(F.col("r_regionkey")) * _REGION + 1,
        F.lit(_REGION), 1, no_box, kind(F.lit("Group"), F.lit("false"), F.lit("SITE"))))
    nations = nation.select(*row(
        F.col("n_nationkey") + 1000, F.col("n_name"), F.col("n_regionkey") + 100,
        base(F.col("n_regionkey"), F.col("n_nationkey")), F.lit(_NATION - 1), 2, no_box,
        kind(F.lit("Group"), F.lit("false"), F.lit("ZONE"))))
    places = nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    c = F.col("c_custkey")
    lo = [F.round(F.col("c_acctbal") / 100), (c % 100).cast("double"), F.col("c_nationkey").cast("double")]
    hi = [lo[0] + c % 7, lo[1] + (c % 5) / 2, lo[2] + c % 3]
    customers = customer.join(places, "c_nationkey").select(*row(
        c + 10000, F.col("c_name"), F.col("c_nationkey") + 1000,
        base(F.col("n_regionkey"), F.col("c_nationkey")) + 1 + c, F.lit(1), 3, box(lo, hi),
        kind(F.initcap("c_mktsegment"), F.when(c % 2 == 0, "true").otherwise("false"), F.lit("PNOD"))))
    return top.unionByName(regions).unionByName(nations).unionByName(customers)


NODES = """nodes AS (
  SELECT CAST(1 AS BIGINT) AS node_id, 'world' AS name, CAST(NULL AS BIGINT) AS parent_id, 0 AS depth, 'Group' AS kind, 'true' AS required, 'WORL' AS pdms,
         CAST(NULL AS DOUBLE) AS x0, CAST(NULL AS DOUBLE) AS y0, CAST(NULL AS DOUBLE) AS z0,
         CAST(NULL AS DOUBLE) AS x1, CAST(NULL AS DOUBLE) AS y1, CAST(NULL AS DOUBLE) AS z1
  UNION ALL SELECT r_regionkey + 100, r_name, 1, 1, 'Group', 'false', 'SITE', NULL, NULL, NULL, NULL, NULL, NULL FROM region
  UNION ALL SELECT n_nationkey + 1000, n_name, n_regionkey + 100, 2, 'Group', 'false', 'ZONE', NULL, NULL, NULL, NULL, NULL, NULL FROM nation
  UNION ALL SELECT c_custkey + 10000, c_name, c_nationkey + 1000, 3,
         upper(c_mktsegment[1]) || lower(c_mktsegment[2:]), CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'false' END, 'PNOD',
         round(c_acctbal / 100), c_custkey % 100, c_nationkey,
         round(c_acctbal / 100) + c_custkey % 7, c_custkey % 100 + (c_custkey % 5) / 2, c_nationkey + c_custkey % 3
  FROM customer)"""


# ------------------------------------------------------------------- relationships

def relationships(spark, sf) -> DataFrame:
    """Two edges per order line: to the part (asset) and to the supplier (file)."""
    line = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    end = lambda kind, key: F.struct(F.lit(kind).alias("type"), F.col(key).cast("string").alias("id"))
    day = epoch_ms(F.col("l_shipdate"))
    return table(spark, sf, "lineitem").select(
        line.alias("line"), F.col("l_orderkey").cast("string").alias("source_external_id"),
        day.alias("start_time"), F.when(F.col("l_linenumber") % 3 != 0, day + F.col("l_quantity").cast("long") * DAY_MS).alias("end_time"),
        (F.lit(1) - F.col("l_discount")).alias("confidence"),
        F.explode(F.array(end("asset", "l_partkey"), end("file", "l_suppkey"))).alias("_t"),
    ).select(
        F.concat("line", F.lit(":"), F.col("_t.type")).alias("external_id"), "source_external_id",
        F.lit("event").alias("source_type"), F.col("_t.id").alias("target_external_id"),
        F.col("_t.type").alias("target_type"), "start_time", "end_time", "confidence",
    )


RELATIONSHIPS = f"""lines AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS line, CAST(l_orderkey AS VARCHAR) AS source_external_id,
         epoch_ms(l_shipdate) AS start_time,
         CASE WHEN l_linenumber % 3 <> 0 THEN epoch_ms(l_shipdate) + CAST(l_quantity AS BIGINT) * {DAY_MS} END AS end_time,
         1 - l_discount AS confidence, l_partkey, l_suppkey FROM lineitem),
rel AS (
  SELECT line || ':asset' AS external_id, source_external_id, 'asset' AS target_type, CAST(l_partkey AS VARCHAR) AS target_external_id,
         start_time, end_time, confidence FROM lines
  UNION ALL
  SELECT line || ':file', source_external_id, 'file', CAST(l_suppkey AS VARCHAR), start_time, end_time, confidence FROM lines)"""


# ------------------------------------------------------------------- raw rows

def raw_json(spark, sf) -> DataFrame:
    """Raw-row JSON lines built from the event table."""
    text = lambda c: F.col(c).cast("string")
    t = F.col("event_type")
    payload = F.concat(
        F.lit('{"key":"'), text("event_id"), F.lit('","lastUpdatedTime":'), epoch_ms(F.col("ts")).cast("string"),
        F.lit(',"columns":{"name":"  '), t, F.lit(' ","k":'), F.get_json_object("props", "$.k"),
        F.lit(',"half":'), (F.get_json_object("props", "$.k").cast("int") - 50.5).cast("string"),
        F.lit(',"flag":'), F.when(F.col("event_id") % 2 == 0, "true").otherwise("false"),
        F.lit(',"one":'), (F.col("user_id") % 2).cast("string"),
        F.lit(',"digits":"'), text("user_id"), F.lit('","none":null,"nested":{"results":[{"status":"'), t,
        F.lit('"},{"status":null},{"status":["a",'), F.get_json_object("props", "$.k"),
        F.lit("]},{\"other\":1}]}}}"),
    )
    return table(spark, sf, "events").select(payload.alias("value"))


RAW = """raw AS (
  SELECT CAST(event_id AS VARCHAR) AS key, epoch_us(ts) // 1000 AS last_updated_time, event_type AS name,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_id, user_id FROM events)"""


# ------------------------------------------------------------------- sequences

def sequence_cells(spark, sf) -> DataFrame:
    """Order lines as sequence cells; the last write of a (sequence, row) counts."""
    from millrace.operators.merge import last_write_wins

    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("external_id"), F.col("l_linenumber").cast("long").alias("row_number"),
        "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate", "l_partkey", "l_suppkey",
    )
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    rows = last_write_wins(lines, ["external_id", "row_number"], order)
    cell = lambda name, kind, num, text: F.struct(
        F.lit(name).alias("column_id"), F.lit(kind).alias("value_type"), num.cast("double").alias("value_num"),
        text.cast("string").alias("value_string"))
    none = F.lit(None)
    cells = F.array(
        cell("quantity", "LONG", F.col("l_quantity"), none), cell("price", "DOUBLE", F.col("l_extendedprice"), none),
        cell("flag", "STRING", none, F.col("l_returnflag")))
    return rows.select("external_id", "row_number", F.explode(cells).alias("c")).select(
        "external_id", "row_number", "c.*")


SEQUENCES = """seq AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS external_id, CAST(l_linenumber AS BIGINT) AS row_number,
         CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice AS price, l_returnflag AS flag
  FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                             ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1)"""


# ------------------------------------------------------------------- runs

def runs(spark, sf) -> DataFrame:
    """Runs per user; views count as heartbeats, purchases as success, errors as failure."""
    status = F.when(F.col("event_type") == "view", "seen").when(F.col("event_type") == "purchase", "success") \
        .when(F.col("event_type") == "error", "failure").otherwise("seen")
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("external_id"), epoch_ms(F.col("ts")).alias("created_time"),
        status.alias("status"), F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("run "), F.col("event_id").cast("string"))).alias("message"),
    )


RUNS = """runs AS (
  SELECT CAST(user_id AS VARCHAR) AS external_id, epoch_us(ts) // 1000 AS created_time,
         CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failure' ELSE 'seen' END AS status,
         CASE WHEN event_id % 3 = 0 THEN 'run ' || event_id END AS message FROM events)"""
