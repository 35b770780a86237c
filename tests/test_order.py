"""The last row of a key in input order, and the error where there is none."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.operators.merge import SPECS, last_write_wins, merge
from millrace.sources.order import POSITION, with_position

EV = "external_id string, type string, metadata map<string,string>"


def test_both_input_orders_give_their_own_last_row(frame, rows):
    target = frame(EV, ("k", "old", None))
    pair = [("k", "a", {"x": "1"}), ("k", "b", {"y": "2"})]
    for order in (pair, pair[::-1]):
        got = merge(target, with_position(frame(EV, *order)), SPECS["events"]).first()
        assert tuple(got) == ("k", order[-1][1], order[-1][2], "updated")
        assert last_write_wins(with_position(frame(EV, *order)), ["external_id"]).first()["type"] == order[-1][1]


def test_many_rows_over_many_partitions(spark):
    rows = spark.range(0, 10_000, 1, 7).select((F.col("id") % 10).alias("k"), "id")
    got = last_write_wins(with_position(rows), ["k"])
    assert sorted(r["id"] for r in got.collect()) == list(range(9990, 10_000))


@pytest.mark.parametrize("form", ["parquet", "json"])
def test_files_by_name_and_row(spark, frame, rows, tmp_path, form):
    ddl, path = "k string, v int", str(tmp_path / "in")
    wide = [("a" if i % 2 else "b", i) for i in range(2000)]
    frame(ddl, *wide).coalesce(1).write.format(form).save(path)
    read = lambda: with_position(spark.read.schema(ddl).format(form).load(path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        assert rows(last_write_wins(read(), ["k"]).select("k", "v")) == [("a", 1999), ("b", 1998)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    frame(ddl, ("a", -1)).coalesce(1).write.mode("append").format(form).save(path)
    newest = last_write_wins(with_position(spark.read.schema(ddl).format(form).load(path), newest_file_last=True), ["k"])
    assert rows(newest.select("k", "v")) == [("a", -1), ("b", 1998)]


def test_no_order_is_an_error_where_rows_differ(frame, rows):
    target = frame(EV, ("k", "old", None))
    twice = frame(EV, ("k", "a", None), ("k", "b", None))
    for made in (merge(target, twice, SPECS["events"]), last_write_wins(twice, ["external_id"])):
        with pytest.raises(PySparkException, match="have no order"):
            made.collect()
    same = frame(EV, ("k", "a", {"x": "1"}), ("k", "a", {"x": "1"}))
    assert merge(target, same, SPECS["events"]).count() == 1


def test_position_leaves_no_column(frame):
    got = merge(frame(EV, ("k", "old", None)), with_position(frame(EV, ("n", "a", None))), SPECS["events"])
    assert POSITION not in got.columns and got.count() == 2
