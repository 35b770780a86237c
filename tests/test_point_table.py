"""Range deletes by merged ranges, stored points by day, and points behind a workspace."""

import random
from pathlib import Path

import pytest
from pyspark.errors import PySparkException

from millrace.operators.points import coalesce_ranges, delete_points
from millrace.sources.order import with_position
from millrace.sources.points import PointTable
from millrace.workspace import Workspace

DAY = 86_400_000
RANGE = "series_id string, inclusive_begin long, exclusive_end long"
POINT = "series_id string, ts_ms long, value_num double"


def test_ranges_are_merged(frame, rows):
    month = 30 * DAY
    got = coalesce_ranges(frame(RANGE, ("a", 1, 3), ("a", 2, 5), ("a", 5, 6), ("a", 8, 9), ("a", 9, 9), ("a", 7, 3), ("b", None, 4), ("b", 3, None),
                                (None, 1, 2), ("c", 10, 3 * month), ("c", month, month + 5), ("c", 3 * month, 3 * month + 1), ("c", 2 * month, 3 * month - 1)))
    assert rows(got) == [("a", 1, 6), ("a", 8, 9), ("b", 0, 2**63 - 1), ("c", 10, 3 * month + 1)]


def world(seed, series=("a", "b", "c"), n=400):
    rng = random.Random(seed)
    points = sorted({(rng.choice(series), rng.randrange(-DAY, 6 * DAY, DAY // 24)) for _ in range(n)})
    ranges = [("a", lo, lo + rng.randrange(0, DAY)) for lo in (rng.randrange(-DAY, 6 * DAY) for _ in range(60))] + [
        ("b", None, DAY), ("b", 2 * DAY, 2 * DAY + 1), ("zz", 0, None), (None, 0, None), ("b", 5 * DAY, None)]
    inside = lambda s, t: any(k == s and (lo or 0) <= t < (2**63 - 1 if hi is None else hi) for k, lo, hi in ranges)
    return points, ranges, [(s, t, 1.0) for s, t in points if not inside(s, t)]


@pytest.mark.parametrize("seed", range(3))
def test_many_overlapping_ranges_on_one_series(frame, rows, seed):
    points, ranges, want = world(seed)
    table = frame(POINT, *[(*p, 1.0) for p in points], (None, 5, 1.0), ("a", None, 1.0))
    got = delete_points(table, frame(RANGE, *ranges))
    assert rows(got.where("series_id is not null and ts_ms is not null")) == want and got.count() == len(want) + 2
    assert got.columns == table.columns


def test_stored_delete_rewrites_touched_days_only(spark, frame, rows, tmp_path):
    points, ranges, want = world(7)
    table = PointTable(spark, str(tmp_path / "p"))
    assert table.delete(frame(RANGE, *ranges)) == []
    table.upsert(frame(POINT, *[(*p, 1.0) for p in points]))
    files = lambda: {d.name: {f.name for f in d.iterdir()} for d in Path(table.path).iterdir() if d.name.startswith("day=")}
    before = files()
    assert table.delete(frame(RANGE, ("a", 2 * DAY + 5, 3 * DAY), ("b", 100 * DAY, None))) == [2]
    assert {d for d in before if before[d] != files()[d]} == {"day=2"}
    table.delete(frame(RANGE, *ranges))
    assert rows(table.read()) == [w for w in want if not (w[0] == "a" and 2 * DAY + 5 <= w[1] < 3 * DAY)]
    # A day that lost all its points is empty, and can be filled again.
    table.delete(frame(RANGE, *[(s, 3 * DAY, 4 * DAY) for s in "abc"]))
    assert table.scan().where("day = 3").count() == 0
    table.upsert(frame(POINT, ("a", 3 * DAY + 1, 9.0)))
    assert rows(table.scan().where("day = 3")) == [("a", 3 * DAY + 1, 9.0, 3)]
    table.delete(frame(RANGE, *[(s, -10 * DAY, None) for s in "abc"]))
    assert table.read().count() == 0


def test_points_of_a_workspace(spark, frame, rows, tmp_path):
    ws = Workspace(spark, str(tmp_path / "ws"), buckets=2)
    ws.timeseries.create(frame("id long, external_id string, name string, is_string boolean, is_step boolean",
                               (7, "seven", "S", False, True), (8, "eight", "E", True, False)))
    ws.datapoints.upsert(frame("id long, external_id string, ts_ms long, value_num double, value_string string",
                               (7, None, 5, 1.0, None), (None, "eight", DAY, None, "x"), (None, "new", 6, 2.0, None)))
    assert rows(ws.datapoints.list(), "external_id", "ts_ms") == [("eight", DAY), ("new", 6), ("seven", 5)]
    headers = {r["external_id"]: r for r in ws.timeseries.table.read().collect()}
    assert set(headers) == {"seven", "eight", "new"} and headers["new"]["is_string"] is False and headers["seven"]["is_step"] is True
    twice = frame("external_id string, ts_ms long, value_num double, value_string string", ("new", 6, 3.0, None), ("new", 6, 4.0, None))
    with pytest.raises(PySparkException, match="have no order"):
        ws.datapoints.upsert(twice)
    ws.datapoints.upsert(with_position(twice))
    assert rows(ws.datapoints.list(0, 10, ["new"]), "ts_ms", "value_num") == [(6, 4.0)]
    ws.datapoints.upsert(frame("external_id string, ts_ms long, value_num double", ("eight", DAY + 1, 5.0)))
    assert rows(ws.datapoints.list(DAY), "ts_ms", "value_num", "value_string") == [(DAY, None, "x"), (DAY + 1, 5.0, None)]
    ws.datapoints.delete(frame("external_id string, inclusive_begin long, exclusive_end long", ("eight", DAY + 1, None)))
    with pytest.raises(ValueError):
        ws.datapoints.table.upsert(frame("external_id string, ts_ms long, other int", ("eight", DAY, 1)))
    with pytest.raises(PySparkException, match="unknown series id 99"):
        ws.datapoints.upsert(frame("id long, ts_ms long, value_num double", (99, 1, 1.0)))
    ws.datapoints.delete(frame("id long, inclusive_begin long, exclusive_end long", (7, 0, 10)))
    assert rows(ws.datapoints.list(), "external_id") == [("eight",), ("new",)]
    with pytest.raises(PySparkException, match="unknown series id null"):
        ws.datapoints.delete(frame("id long, external_id string, inclusive_begin long, exclusive_end long", (None, None, 0, 10)))
