"""Time-series points: aggregates, latest/first, frequency."""

from pyspark.sql import functions as F

from millrace.operators.points import (
    aggregate_points, default_headers, delete_points, first_points, in_window, latest_points, max_frequency,
    points_with_outside, series_points, time_extent,
)
from millrace.lineage import scratch_path
from millrace.sources.points import PointTable
from millrace.sources.rollups import RollupTable
from millrace.workspace import Workspace
from workload.mapping import POINTS, points, rounded, table
from workload.registry import query

START, END = 1_704_105_000_000, 1_706_000_000_000   # 2024-01-01 10:30 UTC and later
HOUR, DAY = 3_600_000, 86_400_000


def _window(origin: int, size: int) -> str:
    return f"ts_ms - (ts_ms - {origin}) % {size}"


_ORIGIN_H = START // HOUR * HOUR
_END_12H = _ORIGIN_H + -(-(END - _ORIGIN_H) // (12 * HOUR)) * 12 * HOUR


@query("points_agg_simple", f"""WITH {POINTS}
SELECT series_id, {_window(_ORIGIN_H, 12 * HOUR)} AS window_start, count(value_num) AS "count",
       round(sum(value_num), 6) AS "sum", min(value_num) AS "min", max(value_num) AS "max",
       round(var_pop(value_num), 6) AS discrete_variance
FROM points WHERE ts_ms >= {_ORIGIN_H} AND ts_ms < {_END_12H} GROUP BY ALL""")
def points_agg_simple(spark, sf):
    df = aggregate_points(points(spark, sf), "12h", ["count", "sum", "min", "max", "discreteVariance"], START, END)
    return rounded(df, "sum", "discrete_variance")


@query("points_agg_60m", f"""WITH {POINTS}
SELECT series_id, {_window(START, HOUR)} AS window_start, count(value_num) AS "count"
FROM points WHERE ts_ms >= {START} GROUP BY ALL""")
def points_agg_60m(spark, sf):
    return aggregate_points(points(spark, sf), "60m", ["count"], START)


@query("points_total_variation", f"""WITH {POINTS}, w AS (
  SELECT series_id, ts_ms - ts_ms % {DAY} AS window_start, ts_ms, value_num,
         lag(value_num) OVER (PARTITION BY series_id, ts_ms - ts_ms % {DAY} ORDER BY ts_ms) AS before FROM points)
SELECT series_id, window_start, round(coalesce(sum(abs(value_num - before)), 0), 6) AS total_variation FROM w GROUP BY ALL""")
def points_total_variation(spark, sf):
    return rounded(aggregate_points(points(spark, sf), "d", ["totalVariation"]), "total_variation")


@query("points_discrete_variance", f"""WITH {POINTS}
SELECT series_id, ts_ms - ts_ms % {2 * DAY} AS window_start, round(var_pop(value_num), 6) AS discrete_variance
FROM points GROUP BY ALL""")
def points_discrete_variance(spark, sf):
    return rounded(aggregate_points(points(spark, sf), "2d", ["discreteVariance"]), "discrete_variance")


def _weighted(size: int, where: str, select: str) -> str:
    """Segments joined to every window they touch: a method independent of the engine's."""
    return f"""WITH {POINTS},
seg AS (SELECT series_id, is_step, ts_ms AS t0, value_num AS v0, lead(ts_ms) OVER w AS t1, lead(value_num) OVER w AS v1
        FROM points WHERE {where} WINDOW w AS (PARTITION BY series_id ORDER BY ts_ms)),
cut AS (SELECT *, unnest(range(t0 - t0 % {size}, t1, {size})) AS win FROM seg WHERE t1 IS NOT NULL),
piece AS (SELECT *, greatest(t0, win) AS a, least(t1, win + {size}) AS b FROM cut),
val AS (SELECT series_id, win, b - a AS len,
               CASE WHEN is_step THEN v0 ELSE v0 + (v1 - v0) * (a - t0) / (t1 - t0) END AS fa,
               CASE WHEN is_step THEN v0 ELSE v0 + (v1 - v0) * (b - t0) / (t1 - t0) END AS fb FROM piece),
agg AS (SELECT series_id, win, sum(len) AS len, sum((fa + fb) / 2 * len) AS area,
               sum((fa * fa + fa * fb + fb * fb) / 3 * len) AS sq FROM val GROUP BY ALL),
occ AS (SELECT series_id, ts_ms - ts_ms % {size} AS win, avg(value_num) AS mean FROM points WHERE {where} GROUP BY ALL)
SELECT o.series_id, o.win AS window_start, {select}
FROM occ o LEFT JOIN agg a ON o.series_id = a.series_id AND o.win = a.win"""


_AVERAGE = "round(CASE WHEN coalesce(a.len, 0) > 0 THEN a.area / a.len ELSE o.mean END, 6) AS average"
_VARIANCE = ("round(CASE WHEN coalesce(a.len, 0) > 0 THEN greatest(a.sq / a.len - (a.area / a.len) * (a.area / a.len), 0) "
             "ELSE 0 END, 4) AS continuous_variance")


@query("points_avg_linear", _weighted(DAY, "NOT is_step", _AVERAGE))
def points_avg_linear(spark, sf):
    linear = points(spark, sf).where("NOT is_step")
    return rounded(aggregate_points(linear, "1d", ["average"], step="is_step"), "average")


@query("points_avg_step", _weighted(DAY, "is_step", _AVERAGE))
def points_avg_step(spark, sf):
    stepped = points(spark, sf).where("is_step")
    return rounded(aggregate_points(stepped, "1d", ["average"], step="is_step"), "average")


@query("points_avg_2h", _weighted(2 * HOUR, "true", _AVERAGE.replace(", 6)", ", 4)")))
def points_avg_2h(spark, sf):
    return rounded(aggregate_points(points(spark, sf), "2h", ["average"], step="is_step"), "average", digits=4)


@query("points_cont_variance", _weighted(DAY, "true", _VARIANCE))
def points_cont_variance(spark, sf):
    df = aggregate_points(points(spark, sf), "24h", ["continuousVariance"], step="is_step")
    return rounded(df, "continuous_variance", digits=4)


_AT_START = f"""WITH {POINTS},
occ AS (SELECT DISTINCT series_id, is_step, ts_ms - ts_ms % {DAY} AS win FROM points),
near AS (SELECT o.*, p.ts_ms AS pt, p.value_num AS pv FROM occ o
         ASOF LEFT JOIN points p ON o.series_id = p.series_id AND o.win >= p.ts_ms),
both_sides AS (SELECT b.*, n.ts_ms AS nt, n.value_num AS nv FROM near b
         ASOF LEFT JOIN points n ON b.series_id = n.series_id AND b.win <= n.ts_ms)
"""


@query("points_interpolation", _AT_START + """
SELECT series_id, win AS window_start, round(CASE WHEN nt = win THEN nv WHEN pt IS NULL THEN NULL WHEN is_step THEN pv
       ELSE pv + (nv - pv) * (win - pt) / (nt - pt) END, 6) AS interpolation FROM both_sides""")
def points_interpolation(spark, sf):
    df = aggregate_points(points(spark, sf), "1d", ["interpolation"], step="is_step")
    return rounded(df, "interpolation")


@query("points_step_interpolation", _AT_START + "SELECT series_id, win AS window_start, pv AS step_interpolation FROM both_sides")
def points_step_interpolation(spark, sf):
    return aggregate_points(points(spark, sf), "1d", ["stepInterpolation"], step="is_step")


@query("points_fill_gaps", f"""WITH {POINTS},
ends AS (SELECT series_id, is_step, min(ts_ms - ts_ms % {6 * HOUR}) AS lo, max(ts_ms - ts_ms % {6 * HOUR}) AS hi FROM points GROUP BY ALL),
grid AS (SELECT series_id, is_step, unnest(range(lo, hi + 1, {6 * HOUR})) AS win FROM ends),
near AS (SELECT o.*, p.ts_ms AS pt, p.value_num AS pv FROM grid o
         ASOF LEFT JOIN points p ON o.series_id = p.series_id AND o.win >= p.ts_ms),
both_sides AS (SELECT b.*, n.ts_ms AS nt, n.value_num AS nv FROM near b
         ASOF LEFT JOIN points n ON b.series_id = n.series_id AND b.win <= n.ts_ms)
SELECT series_id, win AS window_start, round(CASE WHEN nt = win THEN nv WHEN pt IS NULL THEN NULL WHEN is_step THEN pv
       ELSE pv + (nv - pv) * (win - pt) / (nt - pt) END, 6) AS interpolation FROM both_sides""")
def points_fill_gaps(spark, sf):
    df = aggregate_points(points(spark, sf), "6h", ["interpolation"], step="is_step", fill=True)
    return rounded(df, "interpolation")


MID = 1_705_000_000_000
W_LO, W_HI = MID // DAY * DAY, MID // DAY * DAY + 9 * DAY


@query("points_latest", f"""WITH {POINTS}
SELECT series_id, max(ts_ms) AS ts_ms, arg_max(value_num, ts_ms) AS value_num FROM points
WHERE ts_ms < {MID} + series_id * 1000 GROUP BY series_id""")
def points_latest(spark, sf):
    rows = points(spark, sf).select("series_id", "ts_ms", "value_num")
    bounds = rows.select("series_id").distinct().withColumn("exclusive_end", F.lit(MID) + F.col("series_id") * 1000)
    return latest_points(rows, bounds)


@query("points_first", f"""WITH {POINTS}
SELECT series_id, min(ts_ms) AS ts_ms, arg_min(value_num, ts_ms) AS value_num FROM points WHERE ts_ms >= 0 GROUP BY series_id""")
def points_first(spark, sf):
    return first_points(points(spark, sf).select("series_id", "ts_ms", "value_num"))


@query("points_outside", f"""WITH {POINTS}
SELECT series_id, ts_ms, value_num FROM points WHERE ts_ms >= {MID} AND ts_ms < {MID + 3 * DAY}
UNION ALL SELECT series_id, max(ts_ms), arg_max(value_num, ts_ms) FROM points WHERE ts_ms < {MID} GROUP BY series_id
UNION ALL SELECT series_id, min(ts_ms), arg_min(value_num, ts_ms) FROM points WHERE ts_ms >= {MID + 3 * DAY} GROUP BY series_id""")
def points_outside(spark, sf):
    rows = points(spark, sf).select("series_id", "ts_ms", "value_num")
    return points_with_outside(rows, MID, MID + 3 * DAY)


@query("points_max_frequency", f"""WITH {POINTS}, d AS (
  SELECT series_id, (ts_ms // {DAY}) AS day, count(*) AS n FROM points
  WHERE NOT (series_id % 5 = 0) AND ts_ms >= ({END} - 10 * {DAY}) // {DAY} * {DAY} AND ts_ms < {-(-END // DAY) * DAY} GROUP BY ALL)
SELECT round(max(m) / 86400, 9) AS max_frequency FROM (SELECT avg(n) AS m FROM d GROUP BY series_id)""")
def points_max_frequency(spark, sf):
    rows = points(spark, sf).withColumn("is_string", F.col("series_id") % 5 == 0)
    return rounded(max_frequency(rows, START, END, is_string="is_string"), "max_frequency", digits=9)


@query("points_time_extent", f"WITH {POINTS} SELECT min(ts_ms) AS first_ts, max(ts_ms) AS last_ts FROM points")
def points_time_extent(spark, sf):
    return time_extent(points(spark, sf))


@query("points_of_series", f"""WITH {POINTS}
SELECT series_id, ts_ms, value_num FROM points
WHERE series_id IN (SELECT p_size FROM part) AND ts_ms >= {MID} AND ts_ms < {MID + 7 * DAY}""")
def points_of_series(spark, sf):
    series = table(spark, sf, "part").select(F.col("p_size").cast("long").alias("series_id"))
    return series_points(points(spark, sf), series, MID, MID + 7 * DAY).select("series_id", "ts_ms", "value_num")


@query("points_delete_range", f"""WITH {POINTS}
SELECT series_id, ts_ms, value_num FROM points p WHERE NOT EXISTS (
  SELECT 1 FROM customer c WHERE c.c_custkey = p.series_id
    AND p.ts_ms >= {MID} + c.c_nationkey * {HOUR}
    AND p.ts_ms < CASE WHEN c.c_custkey % 4 = 0 THEN 9223372036854775807 ELSE {MID} + (c.c_nationkey + 48) * {HOUR} END)""")
def points_delete_range(spark, sf):
    ranges = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("series_id"),
        (F.lit(MID) + F.col("c_nationkey").cast("long") * HOUR).alias("inclusive_begin"),
        F.when(F.col("c_custkey") % 4 != 0, F.lit(MID) + (F.col("c_nationkey").cast("long") + 48) * HOUR).alias("exclusive_end"))
    return delete_points(points(spark, sf), ranges).select("series_id", "ts_ms", "value_num")


_CUTS = f"""cuts AS (SELECT CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE o_custkey % 100 END AS series_id,
  {START} + o_orderkey % 700 * {HOUR} AS lo, {START} + o_orderkey % 700 * {HOUR} + (30 + o_orderkey % 7 * 10) * 60000 AS hi FROM orders)"""


@query("points_range_deleted_stored", f"""WITH {POINTS}, {_CUTS}
SELECT series_id, ts_ms, value_num FROM points p WHERE NOT EXISTS (
  SELECT 1 FROM cuts c WHERE c.series_id = p.series_id AND p.ts_ms >= c.lo AND p.ts_ms < c.hi)""")
def points_range_deleted_stored(spark, sf):
    """Points stored by day; as many overlapping ranges as orders are deleted, half of them from one series."""
    table_ = PointTable(spark, scratch_path(spark, "points"))
    table_.upsert(points(spark, sf).select("series_id", "ts_ms", "value_num"))
    key = F.col("o_orderkey").cast("long")
    lo = F.lit(START) + key % 700 * HOUR
    table_.delete(table(spark, sf, "orders").select(
        F.when(key % 2 == 0, F.lit(1)).otherwise(F.col("o_custkey") % 100).cast("long").alias("series_id"),
        lo.alias("inclusive_begin"), (lo + (30 + key % 7 * 10) * 60_000).alias("exclusive_end")))
    return table_.read()


@query("points_workspace", f"""WITH {POINTS}
SELECT CAST(series_id AS VARCHAR) AS external_id, ts_ms, value_num,
       CASE WHEN series_id % 3 = 0 THEN 'series ' || series_id ELSE CAST(series_id AS VARCHAR) END AS name
FROM points WHERE ts_ms >= {W_LO} AND ts_ms < {W_HI}""")
def points_workspace(spark, sf):
    """A third of the series have headers and are named by internal ids; the others get default headers."""
    ws = Workspace(spark, scratch_path(spark, "plant"))
    rows = points(spark, sf)
    key = F.col("series_id").cast("string")
    ws.timeseries.create(rows.where("series_id % 3 = 0").select("series_id").distinct().select(
        (F.col("series_id") + 1000).cast("long").alias("id"), key.alias("external_id"), F.concat(F.lit("series "), key).alias("name"),
        F.lit(False).alias("is_string"), F.lit(False).alias("is_step")))
    known = F.col("series_id") % 3 == 0
    ws.datapoints.upsert(rows.select(
        F.when(known, F.col("series_id") + 1000).cast("long").alias("id"), F.when(~known, key).alias("external_id"), "ts_ms", "value_num"))
    names = ws.timeseries.list().select("external_id", "name")
    return ws.datapoints.list(W_LO, W_HI).join(names, "external_id").select("external_id", "ts_ms", "value_num", "name")


@query("points_default_headers", f"""WITH {POINTS}
SELECT CAST(series_id AS VARCHAR) AS external_id, CAST(series_id AS VARCHAR) AS name, false AS is_string,
       bool_or(is_step) AS is_step FROM points
WHERE series_id NOT IN (SELECT p_size FROM part) GROUP BY series_id""")
def points_default_headers(spark, sf):
    rows = points(spark, sf).withColumn("external_id", F.col("series_id").cast("string")).withColumn(
        "value_string", F.lit(None).cast("string"))
    headers = table(spark, sf, "part").select(F.col("p_size").cast("string").alias("external_id")).distinct()
    return default_headers(rows, headers)


@query("points_decoded", f"""WITH {POINTS}
SELECT CAST(series_id AS VARCHAR) AS external_id, is_step, ts_ms, value_num FROM points""")
def points_decoded(spark, sf):
    """Batches of one series and hour as JSON payloads, decoded back to flat points."""
    from millrace.operators.points import decode_point_batches

    rows = points(spark, sf)
    batch = F.to_json(F.struct(
        F.col("series_id").cast("string").alias("externalId"), F.col("is_step").alias("isStep"),
        F.array(F.struct(F.col("ts_ms").alias("timestamp"), F.col("value_num").alias("value"))).alias("datapoints")))
    return decode_point_batches(rows.select(batch.alias("payload"))).select("external_id", "is_step", "ts_ms", "value_num")


# A window of the request that starts and ends inside the data; values must equal those over all points.
_INSIDE = f"WHERE {{w}} >= {W_LO} AND {{w}} < {W_HI}"


@query("points_window_average", _weighted(DAY, "true", _AVERAGE + ", " + _VARIANCE) + "\n" + _INSIDE.format(w="o.win"))
def points_window_average(spark, sf):
    df = aggregate_points(points(spark, sf), "1d", ["average", "continuousVariance"], W_LO, W_HI, step="is_step")
    return rounded(rounded(df, "average"), "continuous_variance", digits=4)


@query("points_window_interpolation", _AT_START + """
SELECT series_id, win AS window_start, round(CASE WHEN nt = win THEN nv WHEN pt IS NULL THEN NULL WHEN is_step THEN pv
       ELSE pv + (nv - pv) * (win - pt) / (nt - pt) END, 6) AS interpolation, pv AS step_interpolation
FROM both_sides """ + _INSIDE.format(w="win"))
def points_window_interpolation(spark, sf):
    df = aggregate_points(points(spark, sf), "1d", ["interpolation", "stepInterpolation"], W_LO, W_HI, step="is_step")
    return rounded(df, "interpolation")


@query("points_decoded_batches", f"""WITH {POINTS}
SELECT CAST(series_id AS VARCHAR) AS external_id, is_step, ts_ms, value_num FROM points""")
def points_decoded_batches(spark, sf):
    """All points of a series and day in one payload, decoded back to flat points."""
    from millrace.operators.points import decode_point_batches

    one = F.struct(F.col("ts_ms").alias("timestamp"), F.col("value_num").alias("value"))
    grouped = points(spark, sf).groupBy("series_id", "is_step", F.floor(F.col("ts_ms") / DAY).alias("d")).agg(F.collect_list(one).alias("datapoints"))
    payload = F.to_json(F.struct(F.col("series_id").cast("string").alias("externalId"), F.col("is_step").alias("isStep"), "datapoints"))
    return decode_point_batches(grouped.select(payload.alias("payload"))).select("external_id", "is_step", "ts_ms", "value_num")


@query("points_upserted", f"""WITH {POINTS}
SELECT series_id, ts_ms, CASE WHEN ts_ms >= {W_LO} AND ts_ms < {W_HI} AND series_id % 3 = 0 THEN value_num + 1 ELSE value_num END AS value_num
FROM points WHERE NOT (ts_ms >= {W_LO} AND ts_ms < {W_HI} AND series_id % 3 = 1)
UNION ALL SELECT series_id, ts_ms, value_num FROM points WHERE ts_ms >= {W_LO} AND ts_ms < {W_HI} AND series_id % 3 = 1""")
def points_upserted(spark, sf):
    """Points stored by day; a window of a third of the series is written again with other values."""
    from millrace.lineage import scratch_path
    from millrace.sources.tables import write_points

    path = scratch_path(spark, "points")
    rows = points(spark, sf).select("series_id", "ts_ms", "value_num")
    write_points(rows, path)
    write_points(in_window(rows, W_LO, W_HI).where("series_id % 3 = 0").withColumn("value_num", F.col("value_num") + 1), path)
    return spark.read.parquet(path).select("series_id", "ts_ms", "value_num")


def _stored_rollups(spark, sf) -> RollupTable:
    """Points and their hourly states, both stored by day."""
    table = PointTable(spark, scratch_path(spark, "rollup-points"))
    table.upsert(points(spark, sf).select("series_id", "ts_ms", "value_num", "is_step"))
    rollups = RollupTable(spark, scratch_path(spark, "rollup-hours"), table, step="is_step")
    rollups.refresh()
    return rollups


@query("rollup_day_curves", _weighted(DAY, "true", f"{_AVERAGE}, {_VARIANCE}"))
def rollup_day_curves(spark, sf):
    df = _stored_rollups(spark, sf).aggregate("1d", ["average", "continuousVariance"])
    return rounded(rounded(df, "average"), "continuous_variance", digits=4)


@query("rollup_12h", f"""WITH {POINTS}
SELECT series_id, {_window(_ORIGIN_H, 12 * HOUR)} AS window_start, count(value_num) AS "count",
       round(sum(value_num), 6) AS "sum", min(value_num) AS "min", max(value_num) AS "max",
       round(var_pop(value_num), 6) AS discrete_variance
FROM points WHERE ts_ms >= {_ORIGIN_H} AND ts_ms < {_END_12H} GROUP BY ALL""")
def rollup_12h(spark, sf):
    df = _stored_rollups(spark, sf).aggregate("12h", ["count", "sum", "min", "max", "discreteVariance"], START, END)
    return rounded(df, "sum", "discrete_variance")


@query("rollup_refreshed", f"""WITH {POINTS}, w AS (
  SELECT series_id, ts_ms - ts_ms % {2 * DAY} AS window_start, ts_ms, value_num,
         lag(value_num) OVER (PARTITION BY series_id, ts_ms - ts_ms % {2 * DAY} ORDER BY ts_ms) AS before
  FROM points WHERE NOT (series_id % 3 = 0 AND ts_ms >= {MID} AND ts_ms < {MID + 3 * DAY}))
SELECT series_id, window_start, count(*) AS "count", round(coalesce(sum(abs(value_num - before)), 0), 6) AS total_variation
FROM w GROUP BY ALL""")
def rollup_refreshed(spark, sf):
    """Every third series loses three days; only the states of the days rewritten by the delete are computed anew."""
    rollups = _stored_rollups(spark, sf)
    lost = points(spark, sf).where("series_id % 3 = 0").select(
        "series_id", F.lit(MID).cast("long").alias("inclusive_begin"), F.lit(MID + 3 * DAY).cast("long").alias("exclusive_end")).distinct()
    rollups.refresh(rollups.points.delete(lost))
    return rounded(rollups.aggregate("2d", ["count", "totalVariation"]), "total_variation")
