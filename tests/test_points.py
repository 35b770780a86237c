import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.operators.points import (
    aggregate_points, decode_point_batches, default_headers, delete_points, first_points, latest_points,
    max_frequency, points_with_outside, with_neighbours,
)
from millrace.sources.tables import write_points

H = 3_600_000
DDL = "series_id string, ts_ms long, value_num double, is_step boolean"
EVERY = ["count", "sum", "min", "max", "average", "interpolation", "stepInterpolation", "continuousVariance",
         "discreteVariance", "totalVariation"]


def expected(points, size, step):
    """Brute force over one series: integrate the curve piece by piece in plain Python."""
    points = sorted(points)
    out = {}
    for t, v in points:
        out.setdefault(t // size * size, []).append((t, v))

    def at(x):
        for (t0, v0), (t1, v1) in zip(points, points[1:]):
            if t0 <= x <= t1:
                if x == t1:
                    return v1
                return v0 if step else v0 + (v1 - v0) * (x - t0) / (t1 - t0)
        return None

    result = {}
    for w, inside in out.items():
        area = square = length = 0.0
        for (t0, v0), (t1, v1) in zip(points, points[1:]):
            a, b = max(t0, w), min(t1, w + size)
            if a >= b:
                continue
            fa = v0 if step else v0 + (v1 - v0) * (a - t0) / (t1 - t0)
            fb = v0 if step else v0 + (v1 - v0) * (b - t0) / (t1 - t0)
            area += (fa + fb) / 2 * (b - a)
            square += (fa * fa + fa * fb + fb * fb) / 3 * (b - a)
            length += b - a
        values = [v for _, v in inside]
        mean = sum(values) / len(values)
        before = [v for t, v in points if t <= w]
        result[w] = {
            "count": len(values), "sum": sum(values), "min": min(values), "max": max(values),
            "average": area / length if length else mean,
            "continuous_variance": max(square / length - (area / length) ** 2, 0) if length else 0.0,
            "discrete_variance": sum((v - mean) ** 2 for v in values) / len(values),
            "total_variation": sum(abs(b - a) for a, b in zip(values, values[1:])),
            "interpolation": dict(points).get(w, at(w) if before else None),
            "step_interpolation": before[-1] if before else None,
        }
    return result


@pytest.mark.parametrize("step", [False, True])
@pytest.mark.parametrize("granularity,size", [("1m", 60_000), ("1h", H), ("2h", 2 * H), ("1d", 24 * H)])
def test_all_aggregates_against_brute_force(spark, step, granularity, size):
    rng = random.Random(7)
    times = sorted(rng.sample(range(0, 5 * 24 * H, 15_000), 120)) + [6 * 24 * H, 6 * 24 * H + size]
    series = [(t, float(rng.randint(-10, 19))) for t in times]
    df = spark.createDataFrame([("a", t, v, step) for t, v in series], DDL)
    got = aggregate_points(df, granularity, EVERY, step="is_step").collect()
    want = expected(series, size, step)
    assert {r["window_start"] for r in got} == set(want)
    for r in got:
        for name, value in want[r["window_start"]].items():
            assert r[name] == (None if value is None else pytest.approx(value, abs=1e-6)), (name, r["window_start"])


def test_lone_point_and_window_edges(frame, rows):
    df = frame(DDL, ("a", 0, 5.0, False), ("b", H, 1.0, False), ("b", 2 * H, 3.0, False))
    got = rows(aggregate_points(df, "1h", ["average", "continuousVariance", "interpolation"], step="is_step"))
    assert got == [("a", 0, 5.0, 0.0, 5.0), ("b", H, 2.0, pytest.approx(1 / 3), 1.0), ("b", 2 * H, 3.0, 0.0, 3.0)]


def test_gap_over_several_windows(frame, rows):
    df = frame(DDL, ("a", 0, 0.0, False), ("a", 4 * H, 8.0, False))
    plain = aggregate_points(df, "1h", ["interpolation", "count"], step="is_step")
    assert rows(plain) == [("a", 0, 0.0, 1), ("a", 4 * H, 8.0, 1)]
    filled = aggregate_points(df, "1h", ["interpolation", "stepInterpolation", "count"], step="is_step", fill=True)
    assert rows(filled) == [("a", 0, 0.0, 0.0, 1), ("a", H, 2.0, 0.0, 0), ("a", 2 * H, 4.0, 0.0, 0),
                            ("a", 3 * H, 6.0, 0.0, 0), ("a", 4 * H, 8.0, 8.0, 1)]


def test_alignment_of_windows(frame, rows):
    df = frame(DDL, ("a", 10 * H + 1_800_000, 1.0, False), ("a", 11 * H, 1.0, False))
    start = 10 * H + 1_800_000
    assert rows(aggregate_points(df, "60m", ["count"], start)) == [("a", start, 2)]
    assert rows(aggregate_points(df, "1h", ["count"], start)) == [("a", 10 * H, 1), ("a", 11 * H, 1)]
    assert rows(aggregate_points(df, "2d", ["count"], 0, 72 * H)) == [("a", 0, 2)]


def test_string_series_is_an_error(frame):
    df = frame(DDL + ", is_string boolean", ("a", 0, 1.0, False, True))
    with pytest.raises(PySparkException):
        aggregate_points(df, "1h", ["average"], is_string="is_string").collect()
    with pytest.raises(ValueError):
        aggregate_points(df, "1h", ["median"])


def test_neighbours_cross_chunks(frame, rows):
    df = frame("k string, ts_ms long, value_num double", ("a", 1, 1.0), ("a", 5, 2.0), ("a", 95, 3.0), ("b", 7, 9.0))
    got = rows(with_neighbours(df, ["k"], chunk_ms=10), "k", "ts_ms", "prev_value_num", "next_ts_ms")
    assert got == [("a", 1, None, 5), ("a", 5, 1.0, 95), ("a", 95, 2.0, None), ("b", 7, None, None)]


def test_hot_series_spreads_over_tasks(spark):
    """The ordered window of the points is keyed by chunk, never by series alone."""
    df = spark.range(1000).selectExpr("'a' AS series_id", "id * 60000 AS ts_ms", "CAST(id AS DOUBLE) AS value_num", "false AS is_step")
    plan = aggregate_points(df, "1h", ["average"])._jdf.queryExecution().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "row_number" in line]
    assert windows and all("_chunk" in line for line in windows)


def test_latest_first_outside(frame, rows):
    df = frame("series_id string, ts_ms long, value_num double", ("a", 1, 1.0), ("a", 5, 2.0), ("a", 9, 3.0), ("b", 5, 7.0))
    assert rows(latest_points(df, 5)) == [("a", 1, 1.0)]
    bounds = frame("series_id string, exclusive_end long", ("a", 9), ("b", 6))
    assert rows(latest_points(df, bounds)) == [("a", 5, 2.0), ("b", 5, 7.0)]
    assert rows(first_points(df)) == [("a", 1, 1.0), ("b", 5, 7.0)]
    assert rows(points_with_outside(df, 2, 9)) == [("a", 1, 1.0), ("a", 5, 2.0), ("a", 9, 3.0), ("b", 5, 7.0)]
    assert rows(points_with_outside(df, 20, 30)) == [("a", 9, 3.0), ("b", 5, 7.0)]


def test_frequency(frame):
    day = 24 * H
    df = frame("series_id string, ts_ms long, value_num double, is_string boolean",
               *[("a", 20 * day + i * 1000, 1.0, False) for i in range(10)],
               *[("s", 20 * day + i * 1000, 1.0, True) for i in range(99)])
    value = lambda a, b: max_frequency(df, a, b, is_string="is_string").first()[0]
    assert value(0, 21 * day) == pytest.approx(10 / 86_400)
    assert value(20 * day, 21 * day) == pytest.approx(10 / 3_600)
    assert value(0, day) == 0.0


def test_decode_batches(frame, rows):
    df = frame("payload string",
               ('{"externalId":"n","isStep":true,"datapoints":[{"timestamp":1,"value":2.5},{"timestamp":2,"value":3}]}',),
               ('{"externalId":"s","datapoints":[{"timestamp":1,"value":"open"}]}',),
               ('{"externalId":"g","datapoints":[{"timestamp":0,"count":2.6,"average":1.5}]}',))
    got = rows(decode_point_batches(df), "external_id", "is_step", "ts_ms", "value_num", "value_string", "count", "average")
    assert got == [("g", False, 0, None, None, 3, 1.5), ("n", True, 1, 2.5, None, None, None),
                   ("n", True, 2, 3.0, None, None, None), ("s", False, 1, None, "open", None, None)]


def test_default_headers(frame, rows):
    points = frame("external_id string, ts_ms long, value_num double, value_string string, is_step boolean",
                   ("a", 1, 1.0, None, True), ("b", 1, None, "x", False), ("c", 1, 1.0, None, False))
    headers = frame("external_id string", ("c",))
    assert rows(default_headers(points, headers)) == [("a", "a", False, True), ("b", "b", True, False)]
    lost = frame("external_id string, ts_ms long, value_num double, value_string string", (None, 1, 1.0, None))
    with pytest.raises(PySparkException):
        default_headers(lost, headers).collect()


def test_delete_ranges(frame, rows):
    df = frame("series_id string, ts_ms long, value_num double", *[("a", t, 1.0) for t in range(5)], ("b", 3, 1.0), ("c", 0, 1.0))
    ranges = frame("series_id string, inclusive_begin long, exclusive_end long", ("a", 1, 3), ("a", 2, 4), ("b", 3, None), ("c", None, 1))
    assert [r[1] for r in rows(delete_points(df, ranges))] == [0, 4]


def test_point_upsert_rewrites_touched_days_only(spark, frame, rows, tmp_path):
    path = str(tmp_path / "points")
    day = 24 * H
    ddl = "series_id string, ts_ms long, value_num double, ord int"
    write_points(frame(ddl, ("a", 1, 1.0, 0), ("a", 1, 2.0, 1), ("a", day, 5.0, 0)), path, order_by=["ord"])
    read = lambda: rows(spark.read.parquet(path), "series_id", "ts_ms", "value_num")
    assert read() == [("a", 1, 2.0), ("a", day, 5.0)]
    kept = {p.name for p in (tmp_path / "points" / "day=1").iterdir()}
    for _ in range(2):
        write_points(frame(ddl, ("a", 1, 9.0, 0), ("b", 2, 4.0, 0)), path, order_by=["ord"])
        assert read() == [("a", 1, 9.0), ("a", day, 5.0), ("b", 2, 4.0)]
    assert {p.name for p in (tmp_path / "points" / "day=1").iterdir()} == kept


@pytest.mark.parametrize("bounds", [(H, None), (H, 2 * H), (None, 2 * H)])
def test_window_values_do_not_depend_on_the_request(frame, bounds):
    points = frame(DDL, ("s", 0, 0.0, False), ("s", 3 * H // 2, 15.0, False), ("s", 2 * H + 1, 30.0, False))
    names = ["average", "interpolation", "stepInterpolation", "continuousVariance"]
    whole = {r["window_start"]: r for r in aggregate_points(points, "1h", names).collect()}
    part = aggregate_points(points, "1h", names, *bounds).collect()
    assert part and all(whole[r["window_start"]] == r for r in part)


def test_days_are_pruned(spark, frame, tmp_path):
    points = frame(DDL, *[("s", d * 24 * H + 5, float(d), False) for d in range(4)])
    write_points(points, str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    plan = aggregate_points(stored, "1d", ["count"], 24 * H, 48 * H)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan or "PartitionFilters: [(day" in plan
    assert [r["count"] for r in aggregate_points(stored, "1d", ["count"], 24 * H, 48 * H).collect()] == [1]
