"""Windows merged from stored hourly states equal those of the points."""

import random

import pytest

from millrace.operators.points import AGGREGATES, OUTPUT, aggregate_points
from millrace.operators.rollups import aggregate_states, roll_up
from millrace.sources.points import PointTable
from millrace.sources.rollups import RollupTable

HOUR, DAY = 3_600_000, 86_400_000
SCHEMA = "series_id long, ts_ms long, value_num double, is_step boolean"


def _points(spark, seed=3, count=400):
    rng = random.Random(seed)
    rows = {(s, rng.randrange(0, 9 * DAY, 60_000)): rng.gauss(1e3 if s == 2 else 0, 3) for s in range(4) for _ in range(count // 4)}
    rows[(1, 3 * HOUR)] = 5.0           # on the border of an hour
    rows[(9, 2 * DAY + 5)] = 7.0        # a lone point
    rows[(0, 4 * DAY)] = None
    return spark.createDataFrame([(s, t, v, s % 2 == 1) for (s, t), v in rows.items()], SCHEMA)


def _rows(df):
    names = sorted(df.columns)
    return {(r["series_id"], r["window_start"]): [r[c] for c in names] for r in df.collect()}


def _same(got, want):
    got, want = _rows(got), _rows(want)
    assert got.keys() == want.keys() and got
    for key, row in want.items():
        assert got[key] == [pytest.approx(v, rel=1e-6, abs=1e-5) if isinstance(v, float) else v for v in row], key


@pytest.mark.parametrize("granularity", ["1h", "5h", "1d", "3d"])
def test_merged_states_equal_points(spark, granularity):
    points = _points(spark)
    states = roll_up(points, step="is_step")
    for start, end in ((None, None), (2 * DAY + 1, 6 * DAY)):
        _same(aggregate_states(states, granularity, AGGREGATES, start, end),
              aggregate_points(points, granularity, AGGREGATES, start, end, step="is_step"))


def test_windows_that_cut_hours_are_errors(spark):
    states = roll_up(_points(spark))
    with pytest.raises(ValueError, match="cut hours"):
        aggregate_states(states, "90m", ["count"])
    with pytest.raises(ValueError, match="cut hours"):
        aggregate_states(states, "60m", ["count"], start=HOUR + 60_000)
    with pytest.raises(ValueError, match="unknown"):
        aggregate_states(states, "1h", ["median"])


def test_empty_points_have_no_states(spark):
    none = roll_up(spark.createDataFrame([], SCHEMA), step="is_step")
    assert none.count() == 0 and aggregate_states(none, "1d", AGGREGATES).count() == 0
    assert set(aggregate_states(none, "1d", ["average"]).columns) == {"series_id", "window_start", OUTPUT["average"]}


def test_refresh_touches_its_days_only(spark, tmp_path):
    table = PointTable(spark, str(tmp_path / "points"))
    table.upsert(_points(spark))
    rollups = RollupTable(spark, str(tmp_path / "hours"), table, step="is_step")
    assert rollups.refresh() == list(range(9))
    files = lambda: {p.parent.name: sorted(x.name for x in p.parent.glob("*.parquet")) for p in (tmp_path / "hours").rglob("*.parquet")}
    before = files()
    table.upsert(spark.createDataFrame([(0, 2 * DAY + 17, 99.0, False)], SCHEMA))
    touched = table.delete(spark.createDataFrame([(s, 5 * DAY, 6 * DAY) for s in range(4)], "series_id long, inclusive_begin long, exclusive_end long"))
    assert rollups.refresh([2, *touched]) == [2, 5]
    after = files()
    assert {d for d in before if before[d] != after[d]} == {"day=2", "day=5"}
    assert rollups.read().where("day = 5").count() == 0
    _same(rollups.aggregate("2d", AGGREGATES), aggregate_points(table.read(), "2d", AGGREGATES, step="is_step"))
    plan = rollups.aggregate("1d", ["sum"], start=3 * DAY, end=4 * DAY)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
