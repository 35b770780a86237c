"""Time-series points: aggregates, neighbours, latest/first, frequency, decoding.

Points are ``(keys..., ts_ms bigint, value_num double[, value_string])`` with at
most one row per key and timestamp.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.functions.durations import DAY_MS, HOUR_MS, Granularity, parse_granularity, resolve_time

SIMPLE = ("count", "sum", "min", "max", "discreteVariance")
NEIGHBOUR = ("totalVariation", "average", "continuousVariance", "interpolation", "stepInterpolation")
AGGREGATES = SIMPLE + NEIGHBOUR

OUTPUT = {
    "count": "count", "sum": "sum", "min": "min", "max": "max", "average": "average",
    "discreteVariance": "discrete_variance", "continuousVariance": "continuous_variance",
    "totalVariation": "total_variation", "interpolation": "interpolation",
    "stepInterpolation": "step_interpolation",
}

# Windows up to this length are their own chunk; longer ones are cut into hours.
_LONGEST_CHUNK = 6 * HOUR_MS


def window_filter(ts: Column, start: int | str | None, end: int | str | None,
                  now_ms: int | None = None) -> Column:
    """``[start, end)`` with epoch milliseconds or relative texts."""
    test = ts >= F.lit(0 if start is None else resolve_time(start, now_ms))
    if end is not None:
        test = test & (ts < F.lit(resolve_time(end, now_ms)))
    return test


def in_window(points: DataFrame, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Points of ``[lo, hi)`` in epoch milliseconds.

    Where the points are stored by ``day``, the days of the window are tested too, so that the
    scan opens only their partitions.
    """
    tests = []
    if lo is not None:
        tests.append(F.col("ts_ms") >= F.lit(lo))
    if hi is not None:
        tests.append(F.col("ts_ms") < F.lit(hi))
    if "day" in points.columns:
        if lo is not None:
            tests.append(F.col("day") >= F.lit(lo // DAY_MS))
        if hi is not None:
            tests.append(F.col("day") <= F.lit((hi - 1) // DAY_MS))
    for test in tests:
        points = points.where(test)
    return points


def series_points(points: DataFrame, series: DataFrame, start=None, end=None,
                  key: str = "series_id", now_ms: int | None = None) -> DataFrame:
    """Points of the listed series in one shared time window."""
    wanted = series.select(key).distinct()
    lo = 0 if start is None else resolve_time(start, now_ms)
    return in_window(points, lo, None if end is None else resolve_time(end, now_ms)).join(wanted, key, "left_semi")


# ------------------------------------------------------------------- neighbours

def with_neighbours(df: DataFrame, keys: Sequence[str], ts: str = "ts_ms",
                    carry: Sequence[str] = ("value_num",), chunk_ms: int = HOUR_MS,
                    origin_ms: int = 0) -> DataFrame:
    """Add ``_chunk`` and ``prev_<c>`` / ``next_<c>`` for the timestamp and carried columns.

    The ordered window runs per (key, time chunk), so one hot key spreads over as
    many tasks as it has chunks. Neighbours across chunk borders come from a table
    of the first and last point per chunk, which is small enough to order per key.
    """
    chunk = F.floor((F.col(ts) - F.lit(origin_ms)) / F.lit(chunk_ms)).cast("long")
    rows = df.withColumn("_chunk", chunk)
    columns = [ts, *carry]
    firsts = [F.min_by(c, ts).alias(f"_first_{c}") if c != ts else F.min(ts).alias(f"_first_{ts}") for c in columns]
    lasts = [F.max_by(c, ts).alias(f"_last_{c}") if c != ts else F.max(ts).alias(f"_last_{ts}") for c in columns]
    per_key = W.partitionBy(*keys).orderBy("_chunk")
    edges = rows.groupBy(*keys, "_chunk").agg(*firsts, *lasts).select(
        *keys, "_chunk",
        *[F.lag(f"_last_{c}").over(per_key).alias(f"_before_{c}") for c in columns],
        *[F.lead(f"_first_{c}").over(per_key).alias(f"_after_{c}") for c in columns],
    )
    per_chunk = W.partitionBy(*keys, "_chunk").orderBy(ts)
    joined = rows.select(
        "*",
        F.row_number().over(per_chunk).alias("_pos"),
        F.lead(F.lit(True)).over(per_chunk).alias("_more"),
        *[F.lag(c).over(per_chunk).alias(f"_lag_{c}") for c in columns],
        *[F.lead(c).over(per_chunk).alias(f"_lead_{c}") for c in columns],
    ).join(edges, [*keys, "_chunk"])
    first, last = F.col("_pos") == 1, F.col("_more").isNull()
    return joined.select(
        *df.columns, "_chunk",
        *[F.when(first, F.col(f"_before_{c}")).otherwise(F.col(f"_lag_{c}")).alias(f"prev_{c}") for c in columns],
        *[F.when(last, F.col(f"_after_{c}")).otherwise(F.col(f"_lead_{c}")).alias(f"next_{c}") for c in columns],
    )


# ------------------------------------------------------------------- aggregates

def _simple(name: str) -> Column:
    v = F.col("value_num")
    return {
        "count": F.count(v), "sum": F.sum(v), "min": F.min(v), "max": F.max(v),
        "discreteVariance": F.var_pop(v),
    }[name].alias(OUTPUT[name])


def _chunking(g: Granularity) -> tuple[int, bool]:
    """Chunk length, and whether every window lies inside one chunk."""
    if g.ms > _LONGEST_CHUNK:
        return HOUR_MS, False
    return g.ms * max(1, HOUR_MS // g.ms), True


def aggregate_points(points: DataFrame, granularity: str, aggregates: Sequence[str],
                     start: int | str | None = None, end: int | str | None = None,
                     keys: Sequence[str] = ("series_id",), step: Column | str | None = None,
                     fill: bool = False, now_ms: int | None = None,
                     is_string: str | None = None) -> DataFrame:
    """Aggregates per series and window; one row per window that holds a point.

    ``step`` names a boolean column (or is a Column over ``points``) telling step
    series from linear ones; absent means linear. ``fill`` also emits the empty
    windows between two points, with interpolations only. The values of a window do not
    depend on ``start`` and ``end``: the nearest points outside take part as neighbours.
    """
    unknown = [a for a in aggregates if a not in AGGREGATES]
    if unknown or not aggregates:
        raise ValueError(f"unknown aggregates {unknown}" if unknown else "no aggregate asked for")
    g = parse_granularity(granularity)
    begin = 0 if start is None else resolve_time(start, now_ms)
    origin = g.align(begin)
    ts = F.col("ts_ms")
    lo = origin if start is not None else None
    hi = g.align_end(begin, resolve_time(end, now_ms)) if end is not None else None
    value = F.col("value_num").cast("double")
    if is_string:
        value = F.when(F.col(is_string), F.raise_error(F.lit("string series have no aggregates")).cast("double")) \
            .otherwise(value)
    is_step = F.lit(False) if step is None else (F.col(step) if isinstance(step, str) else step)
    shaped = lambda part: part.select(
        *keys, "ts_ms", value.alias("value_num"), F.coalesce(is_step, F.lit(False)).alias("_step")
    ).where(F.col("value_num").isNotNull())
    rows = shaped(in_window(points, lo, hi))
    simple = not fill and all(a in SIMPLE for a in aggregates)
    if not simple and lo is not None:
        rows = rows.unionByName(_extreme(shaped(in_window(points, None, lo)), keys, F.max_by, F.max))
    if not simple and hi is not None:
        rows = rows.unionByName(_extreme(shaped(in_window(points, hi, None)), keys, F.min_by, F.min))

    if simple:
        return (
            rows.groupBy(*keys, g.window(ts, origin).alias("window_start"))
            .agg(*[_simple(a) for a in aggregates])
        )
    chunk_ms, nested = _chunking(g)
    rows = with_neighbours(rows, keys, chunk_ms=chunk_ms, origin_ms=origin)
    rows = rows.withColumn("window_start", g.window(ts, origin))
    pieces = _pieces(rows, g)
    group = [*keys, "_chunk", "window_start"] if nested else [*keys, "window_start"]
    result = pieces.groupBy(*group).agg(*_sums(aggregates)).select(
        *keys, "window_start", *[_final(a).alias(OUTPUT[a]) for a in aggregates]
    )
    if fill:
        result = result.unionByName(_gap_windows(rows, g, keys, aggregates))
    if lo is not None:
        result = result.where(F.col("window_start") >= F.lit(lo))
    return result if hi is None else result.where(F.col("window_start") < F.lit(hi))


def _line(a_ts: Column, a: Column, b_ts: Column, b: Column, at: Column) -> Column:
    return a + (b - a) * (at - a_ts) / (b_ts - a_ts)


def _pieces(rows: DataFrame, g: Granularity) -> DataFrame:
    """Per point: the curve from it to the next point or window end, and, for the
    first point of a window, the curve from the window start to it."""
    ts, v, w = F.col("ts_ms"), F.col("value_num"), F.col("window_start")
    pts, pv, nts, nv = (F.col(c) for c in ("prev_ts_ms", "prev_value_num", "next_ts_ms", "next_value_num"))
    step = F.col("_step")
    enters = pts.isNull() | (pts < w)
    entry = F.when(pts.isNotNull() & (pts < w), F.when(step, pv).otherwise(_line(pts, pv, ts, v, w)))
    # least() skips nulls: nothing is drawn after the last point.
    out_end = F.when(nts.isNotNull(), F.least(nts, w + F.lit(g.ms)))
    out_value = F.when(step, v).otherwise(_line(ts, v, nts, nv, out_end))
    rows = rows.select(
        "*", enters.alias("_enters"), entry.alias("_entry"),
        F.when(F.col("_step"), entry).otherwise(v).alias("_entry_end"),
        F.coalesce(F.when(entry.isNotNull(), ts - w), F.lit(0)).cast("double").alias("_in_len"),
        F.coalesce(out_end - ts, F.lit(0)).cast("double").alias("_out_len"),
        out_value.alias("_out"),
    )
    a, b, o = F.col("_entry"), F.col("_entry_end"), F.col("_out")
    area = lambda x, y, d: F.coalesce((x + y) / 2 * d, F.lit(0.0))
    square = lambda x, y, d: F.coalesce((x * x + x * y + y * y) / 3 * d, F.lit(0.0))
    return rows.select(
        "*",
        (F.col("_in_len") + F.col("_out_len")).alias("_len"),
        (area(a, b, F.col("_in_len")) + area(v, o, F.col("_out_len"))).alias("_area"),
        (square(a, b, F.col("_in_len")) + square(v, o, F.col("_out_len"))).alias("_square"),
        F.when(~F.col("_enters"), F.abs(v - pv)).alias("_change"),
        F.when(ts == w, v).when(F.col("_enters"), a).alias("_at_start"),
        F.when(ts == w, v).when(F.col("_enters"), pv).alias("_before_start"),
    )


def _sums(aggregates: Sequence[str]) -> list[Column]:
    columns = [F.sum("_len").alias("_len"), F.sum("_area").alias("_area"), F.avg("value_num").alias("_mean")]
    if "continuousVariance" in aggregates:
        columns.append(F.sum("_square").alias("_square"))
    if "totalVariation" in aggregates:
        columns.append(F.sum("_change").alias("_change"))
    if "interpolation" in aggregates:
        columns.append(F.max("_at_start").alias("_at_start"))
    if "stepInterpolation" in aggregates:
        columns.append(F.max("_before_start").alias("_before_start"))
    return columns + [_simple(a).alias(f"_{a}") for a in aggregates if a in SIMPLE]


def _final(name: str) -> Column:
    length, area = F.col("_len"), F.col("_area")
    if name == "average":
        return F.when(length > 0, F.try_divide(area, length)).otherwise(F.col("_mean"))
    if name == "continuousVariance":
        mean = F.try_divide(area, length)
        return F.when(length > 0, F.greatest(F.try_divide(F.col("_square"), length) - mean * mean, F.lit(0.0))) \
            .otherwise(F.lit(0.0))
    if name == "totalVariation":
        return F.coalesce(F.col("_change"), F.lit(0.0))
    if name == "interpolation":
        return F.col("_at_start")
    if name == "stepInterpolation":
        return F.col("_before_start")
    return F.col(f"_{name}")


def _gap_windows(rows: DataFrame, g: Granularity, keys: Sequence[str], aggregates: Sequence[str]) -> DataFrame:
    """Windows strictly between the windows of two neighbouring points."""
    ts, v, w = F.col("ts_ms"), F.col("value_num"), F.col("window_start")
    pts, pv = F.col("prev_ts_ms"), F.col("prev_value_num")
    after = pts - F.pmod(pts - w, F.lit(g.ms)) + F.lit(g.ms)
    gaps = rows.where(after < w).withColumn("_gap", F.explode(F.sequence(after, w - F.lit(g.ms), F.lit(g.ms))))
    at = F.col("_gap")
    columns = {
        "interpolation": F.when(F.col("_step"), pv).otherwise(_line(pts, pv, ts, v, at)),
        "stepInterpolation": pv,
        "count": F.lit(0).cast("long"),
    }
    return gaps.select(
        *keys, at.alias("window_start"),
        *[columns.get(a, F.lit(None).cast("double")).alias(OUTPUT[a]) for a in aggregates],
    )


# ------------------------------------------------------- latest, first, outside

def latest_points(points: DataFrame, before: DataFrame | int | str | None = None,
                  keys: Sequence[str] = ("series_id",), now_ms: int | None = None) -> DataFrame:
    """Latest point per series strictly before its bound.

    ``before`` is one shared bound, or a frame ``(keys..., exclusive_end)``.
    """
    rows = points
    if isinstance(before, DataFrame):
        rows = rows.join(before, list(keys)).where(F.col("ts_ms") < F.col("exclusive_end"))
        rows = rows.select(*points.columns)
    elif before is not None:
        rows = in_window(rows, None, resolve_time(before, now_ms))
    return _extreme(rows, keys, F.max_by, F.max)


def first_points(points: DataFrame, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """First point per series at or after the epoch."""
    return _extreme(in_window(points, 0), keys, F.min_by, F.min)


def _extreme(rows: DataFrame, keys: Sequence[str], pick, bound) -> DataFrame:
    others = [c for c in rows.columns if c not in keys and c != "ts_ms"]
    return rows.groupBy(*keys).agg(
        bound("ts_ms").alias("ts_ms"), *[pick(c, "ts_ms").alias(c) for c in others]
    ).select(*rows.columns)


def points_with_outside(points: DataFrame, start: int | str, end: int | str,
                        keys: Sequence[str] = ("series_id",), now_ms: int | None = None) -> DataFrame:
    """Points of ``[start, end)`` plus the last one before and the first one at or after it."""
    lo, hi = resolve_time(start, now_ms), resolve_time(end, now_ms)
    inside = in_window(points, lo, hi)
    before = latest_points(points, lo, keys)
    after = _extreme(in_window(points, hi), keys, F.min_by, F.min)
    return inside.unionByName(before).unionByName(after)


# --------------------------------------------------------------- extent, frequency

def time_extent(points: DataFrame) -> DataFrame:
    return points.agg(F.min("ts_ms").alias("first_ts"), F.max("ts_ms").alias("last_ts"))


def max_frequency(points: DataFrame, start_ms: int, end_ms: int, keys: Sequence[str] = ("series_id",),
                  is_string: str | None = None) -> DataFrame:
    """Highest average sampling frequency (points per second) over the numeric series.

    Counts per day (per hour for windows up to a day) of at most the last ten days,
    averaged over the windows that hold points, then the maximum over series.
    """
    begin = max(start_ms, end_ms - 10 * DAY_MS)
    unit, seconds = ("d", 86_400) if end_ms - begin > DAY_MS else ("h", 3_600)
    rows = points.where(~F.col(is_string)) if is_string else points
    counts = aggregate_points(rows, unit, ["count"], begin, end_ms, keys)
    means = counts.groupBy(*keys).agg(F.avg("count").alias("_mean"))
    return means.agg(F.coalesce(F.max("_mean") / F.lit(seconds), F.lit(0.0)).alias("max_frequency"))


# ------------------------------------------------------------------- decoding

POINT_BATCH_DDL = """
    id bigint, externalId string, isString boolean, isStep boolean, unit string,
    datapoints array<struct<
        timestamp: bigint, value: variant, average: double, max: double, min: double, count: double,
        sum: double, interpolation: double, stepInterpolation: double, continuousVariance: double,
        discreteVariance: double, totalVariation: double>>
"""


def decode_point_batches(batches: DataFrame, payload: str = "payload") -> DataFrame:
    """JSON point batches (one series each) to flat rows with the series header copied on."""
    parsed = batches.select(F.from_json(payload, POINT_BATCH_DDL).alias("b"))
    p = F.col("p")
    kind = F.schema_of_variant(p["value"])
    return parsed.select("b.*").select(
        F.col("id"), F.col("externalId").alias("external_id"),
        F.coalesce("isStep", F.lit(False)).alias("is_step"), F.explode("datapoints").alias("p"),
    ).select(
        "id", "external_id", "is_step", p["timestamp"].alias("ts_ms"),
        F.when(kind != "STRING", F.try_variant_get(p["value"], "$", "double")).alias("value_num"),
        F.when(kind == "STRING", F.try_variant_get(p["value"], "$", "string")).alias("value_string"),
        F.floor(p["count"] + F.lit(0.5)).cast("long").alias("count"),
        *[p[a].alias(OUTPUT[a]) for a in AGGREGATES if a != "count"],
    )


def default_headers(points: DataFrame, headers: DataFrame, key: str = "external_id") -> DataFrame:
    """Header rows for series that have points but no header.

    A missing series known only by an internal id cannot be created: its row raises.
    """
    missing = points.join(headers.select(key), key, "left_anti") if key in points.columns else points
    step = F.max("is_step") if "is_step" in points.columns else F.lit(False)
    return missing.groupBy(key).agg(
        (F.count("value_string") > 0).alias("is_string"), F.coalesce(step, F.lit(False)).alias("is_step")
    ).select(
        F.when(F.col(key).isNull(), F.raise_error(F.lit("series without external id does not exist")).cast("string"))
        .otherwise(F.col(key)).alias(key),
        F.col(key).alias("name"),
        "is_string", "is_step",
    )


_FOREVER = 2**63 - 1


def coalesce_ranges(ranges: DataFrame, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """``(keys, begin, end)``: the same instants as disjoint ranges that do not touch.

    An unset begin is 0, an unset end is open; empty ranges and those without a series are left out. Gaps
    and islands: ranges are merged within the month of their begin first, so that a series of very many
    ranges is settled by many tasks, then within the series.
    """
    known = [F.col(k).isNotNull() for k in keys]
    rows = ranges.select(
        *keys, F.coalesce("inclusive_begin", F.lit(0)).cast("long").alias("begin"),
        F.coalesce("exclusive_end", F.lit(_FOREVER)).cast("long").alias("end")).where("begin < end")
    for test in known:
        rows = rows.where(test)

    def islands(rows: DataFrame, by: list[str]) -> DataFrame:
        along = W.partitionBy(*by).orderBy("begin", "end")
        reach = F.max("end").over(along.rowsBetween(W.unboundedPreceding, -1))
        fresh = rows.withColumn("_fresh", (reach.isNull() | (F.col("begin") > reach)).cast("int"))
        numbered = fresh.withColumn("_island", F.sum("_fresh").over(along.rowsBetween(W.unboundedPreceding, 0)))
        return numbered.groupBy(*by, "_island").agg(F.min("begin").alias("begin"), F.max("end").alias("end")).drop("_island")

    month = F.floor(F.col("begin") / F.lit(30 * DAY_MS)).alias("_month")
    return islands(islands(rows.select("*", month), [*keys, "_month"]).drop("_month"), list(keys)).select(*keys, "begin", "end")


def cut_at_days(ranges: DataFrame, first_day: int, last_day: int) -> DataFrame:
    """Ranges ``(..., begin, end)`` cut at midnight, with their ``day``, within ``[first_day, last_day]``."""
    low = F.greatest(F.floor(F.col("begin") / F.lit(DAY_MS)).cast("long"), F.lit(first_day))
    high = F.least(F.floor((F.col("end") - 1) / F.lit(DAY_MS)).cast("long"), F.lit(last_day))
    days = ranges.withColumn("_low", low).withColumn("_high", high).where("_low <= _high").withColumn(
        "day", F.explode(F.sequence("_low", "_high"))).drop("_low", "_high")
    return days.withColumn("begin", F.greatest("begin", F.col("day") * F.lit(DAY_MS))).withColumn(
        "end", F.least("end", (F.col("day") + 1) * F.lit(DAY_MS)))


def without_ranges(points: DataFrame, cut: DataFrame, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """Points, with their ``day``, outside disjoint ranges cut at days.

    Only points of a (series, day) that has a range are moved. There ranges and points are ordered by time,
    and the last range begun before a point decides, so the work does not grow with ranges times points.
    """
    by = [*keys, "day"]
    hit = cut.select(*by).distinct()
    # A missing series or time meets no range.
    clear = points.join(hit, by, "left_anti")
    marks = cut.select(*by, F.col("begin").alias("ts_ms"), F.col("end").alias("_end"))
    mixed = points.join(hit, by, "left_semi").withColumn("_end", F.lit(None).cast("long")).unionByName(
        marks.withColumn("_mark", F.lit(True)), allowMissingColumns=True)
    along = W.partitionBy(*by).orderBy("ts_ms", F.col("_end").isNull()).rowsBetween(W.unboundedPreceding, 0)
    reach = F.last("_end", ignorenulls=True).over(along)
    kept = mixed.withColumn("_reach", reach).where("_mark is null and (_reach is null or ts_ms >= _reach)")
    return clear.unionByName(kept.select(*points.columns))


def delete_points(points: DataFrame, ranges: DataFrame, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """Drop points in any ``[inclusive_begin, exclusive_end)`` of their series.

    An unset begin is 0 and an unset end is open. Overlapping ranges are merged first and then met
    by series and day.
    """
    extent = time_extent(points).first()
    if extent["first_ts"] is None:
        return points
    cut = cut_at_days(coalesce_ranges(ranges, keys), extent["first_ts"] // DAY_MS, extent["last_ts"] // DAY_MS)
    day = F.floor(F.col("ts_ms") / F.lit(DAY_MS)).cast("long")
    return without_ranges(points.withColumn("day", day), cut, keys).select(*points.columns)
