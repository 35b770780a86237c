"""Hourly states of time series, from which every longer window is merged.

A state holds what an hour gives to any window: its first and last point, sums, extremes, the squared
deviations, and the integrals of the curve and its square between its first and last point. Merging needs the
curve between two states only, which their end points give. States of one hour do not depend on other hours,
so new points make only their own hours stale.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.functions.durations import DAY_MS, HOUR_MS, parse_granularity, resolve_time
from millrace.operators.points import AGGREGATES, OUTPUT, _extreme, _final, _line, in_window, with_neighbours

# States of a series that one ordered window holds: those of 64 days, 1536 at most.
_CHUNK = 64 * DAY_MS


def _area(a: Column, b: Column, length: Column) -> Column:
    return F.coalesce((a + b) / 2 * length, F.lit(0.0))


def _square(a: Column, b: Column, length: Column) -> Column:
    return F.coalesce((a * a + a * b + b * b) / 3 * length, F.lit(0.0))


def roll_up(points: DataFrame, keys: Sequence[str] = ("series_id",), step: Column | str | None = None) -> DataFrame:
    """One state per series and hour that holds a number; ``ts_ms`` is the start of the hour.

    ``step`` names a boolean column (or is one) that tells step series; it is kept in the state. One shuffle
    by series and hour.
    """
    ts, v = F.col("ts_ms"), F.col("value_num")
    is_step = F.lit(False) if step is None else (F.col(step) if isinstance(step, str) else step)
    hour = (ts - F.pmod(ts, F.lit(HOUR_MS))).alias("_hour")
    rows = points.select(*keys, "ts_ms", F.col("value_num").cast("double").alias("value_num"),
                         F.coalesce(is_step, F.lit(False)).alias("is_step"), hour).where("value_num is not null")
    over = W.partitionBy(*keys, "_hour").orderBy("ts_ms")
    rows = rows.withColumn("_to", F.lead("ts_ms").over(over)).withColumn("_next", F.lead("value_num").over(over))
    length = (F.col("_to") - ts).cast("double")
    end = F.when(F.col("is_step"), v).otherwise(F.col("_next"))
    return rows.groupBy(*keys, "_hour").agg(
        F.min("ts_ms").alias("first_ts"), F.min_by("value_num", "ts_ms").alias("first_value"),
        F.max("ts_ms").alias("last_ts"), F.max_by("value_num", "ts_ms").alias("last_value"),
        F.max("is_step").alias("is_step"), F.count(v).alias("n"), F.sum(v).alias("total"),
        F.min(v).alias("least"), F.max(v).alias("most"), (F.var_pop(v) * F.count(v)).alias("deviation"),
        F.sum(_area(v, end, length)).alias("area"), F.sum(_square(v, end, length)).alias("square"),
        F.sum(F.coalesce(F.abs(F.col("_next") - v), F.lit(0.0))).alias("variation"),
    ).withColumnRenamed("_hour", "ts_ms")


def aggregate_states(states: DataFrame, granularity: str, aggregates: Sequence[str], start: int | str | None = None,
                     end: int | str | None = None, keys: Sequence[str] = ("series_id",), now_ms: int | None = None) -> DataFrame:
    """What ``aggregate_points`` gives for the points behind the states, for windows made of whole hours.

    States that carry a ``day`` are read with a day predicate. A granularity or a start that cuts hours is an error.
    """
    unknown = [a for a in aggregates if a not in AGGREGATES]
    if unknown or not aggregates:
        raise ValueError(f"unknown aggregates {unknown}" if unknown else "no aggregate asked for")
    g = parse_granularity(granularity)
    begin = 0 if start is None else resolve_time(start, now_ms)
    origin = g.align(begin)
    if g.ms % HOUR_MS or origin % HOUR_MS:
        raise ValueError(f"windows of {granularity!r} from {origin} cut hours")
    lo = origin if start is not None else None
    hi = g.align_end(begin, resolve_time(end, now_ms)) if end is not None else None
    rows = in_window(states, lo, hi).drop("day")
    if lo is not None:
        rows = rows.unionByName(_extreme(in_window(states, None, lo).drop("day"), keys, F.max_by, F.max))
    if hi is not None:
        rows = rows.unionByName(_extreme(in_window(states, hi).drop("day"), keys, F.min_by, F.min))
    rows = with_neighbours(rows, keys, carry=("first_ts", "first_value", "last_ts", "last_value"), chunk_ms=_CHUNK, origin_ms=origin)
    rows = _joined(rows.withColumn("window_start", g.window(F.col("ts_ms"), origin)), g.ms)
    group = [*keys, "window_start"]
    if "discreteVariance" in aggregates:
        # Deviations are taken from the mean of the window, so that large values lose no digits.
        over = W.partitionBy(*group)
        mean = F.sum("total").over(over) / F.sum("n").over(over)
        shift = F.col("total") / F.col("n") - mean
        rows = rows.withColumn("deviation", F.col("deviation") + F.col("n") * shift * shift)
    result = rows.groupBy(*group).agg(
        F.sum("_len").alias("_len"), F.sum("_area").alias("_area"), F.sum("_square").alias("_square"),
        F.sum("_change").alias("_change"), F.max("_at_start").alias("_at_start"), F.max("_before_start").alias("_before_start"),
        (F.sum("total") / F.sum("n")).alias("_mean"), F.sum("n").alias("_count"), F.sum("total").alias("_sum"),
        F.min("least").alias("_min"), F.max("most").alias("_max"), (F.sum("deviation") / F.sum("n")).alias("_discreteVariance"),
    ).select(*group, *[_final(a).alias(OUTPUT[a]) for a in aggregates])
    if lo is not None:
        result = result.where(F.col("window_start") >= F.lit(lo))
    return result if hi is None else result.where(F.col("window_start") < F.lit(hi))


def _joined(rows: DataFrame, size: int) -> DataFrame:
    """Per state: its own integrals, those up to the next state or the end of the window, and, for the first state of
    a window, those from the start of the window."""
    w, step = F.col("window_start"), F.col("is_step")
    first_ts, first, last_ts, last = (F.col(c) for c in ("first_ts", "first_value", "last_ts", "last_value"))
    prev_ts, prev, next_ts, next_value = (F.col(c) for c in ("prev_last_ts", "prev_last_value", "next_first_ts", "next_first_value"))
    enters = prev_ts.isNull() | (prev_ts < w)
    entry = F.when(prev_ts < w, F.when(step, prev).otherwise(_line(prev_ts, prev, first_ts, first, w)))
    out_end = F.when(next_ts.isNotNull(), F.least(next_ts, w + F.lit(size)))
    rows = rows.select(
        "*", enters.alias("_enters"), entry.alias("_entry"),
        F.when(entry.isNotNull(), first_ts - w).otherwise(0).cast("double").alias("_in_len"),
        F.coalesce(out_end - last_ts, F.lit(0)).cast("double").alias("_out_len"),
        F.when(step, last).otherwise(_line(last_ts, last, next_ts, next_value, out_end)).alias("_out"))
    a, out, in_len, out_len = (F.col(c) for c in ("_entry", "_out", "_in_len", "_out_len"))
    b = F.when(step, a).otherwise(first)
    return rows.select(
        "*", (in_len + (last_ts - first_ts) + out_len).alias("_len"),
        (F.col("area") + _area(a, b, in_len) + _area(last, out, out_len)).alias("_area"),
        (F.col("square") + _square(a, b, in_len) + _square(last, out, out_len)).alias("_square"),
        (F.col("variation") + F.when(F.col("_enters"), 0.0).otherwise(F.abs(first - prev))).alias("_change"),
        F.when(first_ts == w, first).when(F.col("_enters"), a).alias("_at_start"),
        F.when(first_ts == w, first).when(F.col("_enters"), prev).alias("_before_start"))
