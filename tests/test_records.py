import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.operators.sequences import (
    delete_rows, extend_header, infer_columns, read_rows, schema_diff, to_long, to_wide, upsert_rows,
)
from millrace.sources.files import join_contents, read_contents, upload
from millrace.sources.raw import parse_raw_rows, raw_delete, raw_scan, raw_upsert, relabel, typed_rows
from millrace.sources.tables import VersionedTable, parse_slice, scan_slice


def test_raw_rows_and_rejects(frame, rows):
    lines = frame("value string",
                  ('{"key":"a","lastUpdatedTime":5,"columns":{"x":1,"s":"t"}}',), ('{"key":"b","lastUpdatedTime":9,"columns":{}}',),
                  ('{"key":7,"lastUpdatedTime":5,"columns":{}}',), ('{"key":"c","lastUpdatedTime":"5","columns":{}}',),
                  ('{"key":"c","lastUpdatedTime":5,"columns":[]}',), ('{"key":"c","lastUpdatedTime":5}',), ("nope",), ("[1]",))
    found, rejects = parse_raw_rows(lines, "db", "t")
    assert rows(found, "key", "last_updated_time") == [("a", 5), ("b", 9)]
    assert rejects.count() == 6
    assert [r[0] for r in rows(rejects.select("reason"))].count("columns is not an object") == 2

    assert raw_scan(found, "db", "t", columns=[]).columns == ["db_name", "table_name", "key", "last_updated_time"]
    picked = raw_scan(found, "db", "t", columns=["x", "none"]).where("key = 'a'").first()
    assert str(picked["x"].toPython()) == "1" and picked["none"] is None
    # min is exclusive, max inclusive
    assert rows(raw_scan(found, "db", "t", columns=[], after=5, until=9), "key") == [("b",)]
    assert raw_scan(found, "db", "other").count() == 0

    newer = relabel(found.where("key = 'a'"), table="t").withColumn("last_updated_time", F.lit(6).cast("long"))
    after = raw_upsert(found, newer.unionByName(found)).drop("_change")
    assert rows(after, "key", "last_updated_time") == [("a", 6), ("b", 9)]
    assert rows(raw_delete(after, newer), "key") == [("b",)]


def test_typed_rows(frame, rows):
    lines = frame("value string", ('{"externalId":"a","startTime":"soon","metadata":{"k":"v"}}',), ('{"startTime":1}',), ("{",))
    found, rejects = typed_rows(lines, "externalId string, startTime bigint, metadata map<string,string>", ["externalId"])
    assert found.first().asDict() == {"externalId": "a", "startTime": None, "metadata": {"k": "v"}}
    assert rejects.count() == 2


BODY = "external_id string, columns array<struct<external_id:string,value_type:string>>, row_number long, v array<string>"
COLUMNS = [("d", "DOUBLE"), ("l", "LONG"), ("s", "STRING")]


def bodies(frame, *items):
    df = frame(BODY, *[("q", COLUMNS, n, v) for n, v in items])
    return df.withColumn("values", F.transform("v", lambda t: F.parse_json(t))).drop("v")


def test_bodies_to_wide(frame, rows):
    cells = to_long(bodies(frame, (0, ["1.5", "2.9", '"x"']), (1, ["null", "-2.9", "null"])))
    wide = to_wide(cells, {"d": "DOUBLE", "l": "LONG", "s": "STRING"})
    assert rows(wide) == [("q", 0, 1.5, 2, "x"), ("q", 1, None, -2, None)]
    assert rows(read_rows(cells, 1, 2, ["l"]), "row_number", "column_id") == [(1, "l")]
    with pytest.raises(PySparkException):
        to_long(bodies(frame, (0, ["1", "2", "3"]))).collect()


def test_header_inference(frame, rows):
    ddl = "external_id string, row_number long, column_id string, value_num double, value_string string"
    cells = frame(ddl, ("q", 0, "a", None, None), ("q", 1, "a", 2.0, None), ("q", 0, "b", None, "t"))
    assert rows(infer_columns(cells)) == [("q", "a", "DOUBLE"), ("q", "b", "STRING")]
    header = frame("external_id string, column_id string, value_type string", ("q", "a", "LONG"))
    assert rows(extend_header(cells, header)) == [("q", "a", "LONG"), ("q", "b", "STRING")]
    for bad in ((("q", 0, "n", None, None),), (("q", 0, "m", 1.0, None), ("q", 1, "m", None, "t"))):
        with pytest.raises(PySparkException):
            infer_columns(frame(ddl, *bad)).collect()


def test_schema_diff(frame, rows):
    ddl = "external_id string, column_id string, value_type string"
    old = frame(ddl, ("q", "a", "DOUBLE"), ("q", "b", "STRING"))
    new = frame(ddl, ("q", "a", "DOUBLE"), ("q", "c", "LONG"))
    assert rows(schema_diff(new, old)) == [("q", "a", "modify"), ("q", "c", "add")]
    assert rows(schema_diff(new, old, replace=True)) == [("q", "a", "modify"), ("q", "b", "remove"), ("q", "c", "add")]
    with pytest.raises(ValueError):
        schema_diff(frame(ddl, ("q", "a", "STRING")), old)


def test_row_upsert_and_delete(frame, rows):
    ddl = "external_id string, row_number long, column_id string, value_num double, value_string string"
    cells = frame(ddl, ("q", 0, "a", 1.0, None), ("q", 1, "a", 2.0, None), ("p", 1, "a", 3.0, None))
    after = upsert_rows(cells, frame(ddl, ("q", 1, "a", None, None), ("q", 2, "a", 5.0, None))).drop("_change")
    assert rows(after, "external_id", "row_number", "value_num") == [("p", 1, 3.0), ("q", 0, 1.0), ("q", 1, None), ("q", 2, 5.0)]
    wanted = frame("external_id string, row_numbers array<long>", ("q", [0, 0]), ("q", [2]))
    assert rows(delete_rows(after, wanted), "external_id", "row_number") == [("p", 1), ("q", 1)]


def test_slices_are_disjoint_and_complete(spark):
    df = spark.range(1000).selectExpr("CAST(id AS STRING) AS k")
    parts = [set(r[0] for r in scan_slice(df, "k", i, 7).collect()) for i in range(1, 8)]
    assert sum(map(len, parts)) == 1000 and len(set().union(*parts)) == 1000
    assert parse_slice("3/8") == (3, 8)
    with pytest.raises(ValueError):
        scan_slice(df, "k", 8, 7)


def test_file_contents(spark, frame, rows, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿header-a;header-b\n;x\n".encode())
    (tmp_path / "b.csv").write_bytes(b"1")
    contents = read_contents(spark, str(tmp_path), "*.csv")
    files = frame("external_id string, id long, source string", ("a.csv", 1, "s"), ("c.csv", 2, "t"))
    got = rows(join_contents(contents, files), "external_id", "content_length", "has_metadata", "source")
    assert got == [("a.csv", 24, True, "s"), ("b.csv", 1, False, None)]
    by_id = join_contents(frame("external_id string, id long, n int", (None, 2, 7)), files)
    assert by_id.first()["source"] == "t"

    table = frame("external_id string, name string, uploaded boolean, content_length long, content binary", ("a", "n", False, None, None))
    done = upload(table, frame("external_id string, name string, content binary, ord int",
                               ("a", "other", bytearray(b"xy"), 0), ("a", "other", bytearray(b"xyz"), 1)), ["ord"]).first()
    assert (done["name"], done["uploaded"], done["content_length"]) == ("n", True, 3)


def test_versions_can_be_read_while_replaced(spark, frame, rows, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    table.commit(frame("k string", ("a",)), batch_id=0)
    first = table.read()
    table.commit(table.read().unionByName(frame("k string", ("b",))), batch_id=1)
    assert table.commit(frame("k string", ("zzz",)), batch_id=1) == 2      # replayed batch
    assert rows(first) == [("a",)] and rows(table.read()) == [("a",), ("b",)] and rows(table.read(1)) == [("a",)]


def test_half_written_version_is_ignored(spark, frame, rows, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.commit(frame("k string", ("a",)))
    frame("k string", ("broken",)).write.parquet(str(tmp_path / "t" / "v=2"))
    assert rows(table.read()) == [("a",)]
    table.commit(frame("k string", ("c",)))
    assert rows(table.read()) == [("c",)]


def test_upserted_raw_rows_are_parsed_once(spark):
    from workload.records import raw_upserted

    assert not [f for f in raw_upserted(spark, "/root/testdata/sf0.001").inputFiles() if "events.parquet" in f]
