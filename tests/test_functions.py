import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.functions import geo
from millrace.functions.collections import merge_map, same_list, same_map
from millrace.functions.durations import parse_duration, parse_granularity, resolve_time
from millrace.functions.values import (
    json_attribute, struct_delimited, struct_strings, utf8_bytes, value_to_boolean, value_to_double,
    value_to_long, value_to_string,
)


def test_durations():
    assert parse_duration("now") == 0
    assert parse_duration("2w-ago") == 14 * 86_400_000
    assert parse_duration("15m") == 900_000
    assert parse_duration("minute") == 60_000
    assert resolve_time("1h-ago", now_ms=7_200_000) == 3_600_000
    assert resolve_time(42) == 42
    for bad in ("", "2w", "1x-ago", "h-ago", "1.5h", "1weeks"):
        with pytest.raises(ValueError):
            parse_duration(bad)
    with pytest.raises(ValueError):
        resolve_time("1h")
    with pytest.raises(ValueError):
        parse_granularity("0h")


def test_alignment_differs_between_unit_and_count():
    start = 10 * 3_600_000 + 1_800_000
    assert parse_granularity("60m").align(start) == start
    assert parse_granularity("1h").align(start) == 10 * 3_600_000
    days = parse_granularity("2d")
    assert days.align_end(0, 3 * 86_400_000) == 4 * 86_400_000


def _values(frame, *texts):
    return frame("n int, t string", *enumerate(texts)).select("n", F.parse_json("t").alias("v"))


def test_value_texts(frame, rows):
    df = _values(frame, "1", "-2.5", '" a b\\t"', "true", "null", "[1,2]", None, "1e3")
    got = [r[1] for r in rows(df.select("n", value_to_string(F.col("v"))))]
    assert got == ["1.0", "-2.5", "a b", "true", "null", "[1,2]", "", "1000.0"]


def test_value_numbers(frame, rows):
    df = _values(frame, "-2.5", "2.5", '"12"', '"12.5"', "true", '"x"')
    longs = [r[1] for r in rows(df.select("n", value_to_long(F.col("v"))))]
    assert longs == [-2, 3, 12, None, None, None]
    doubles = [r[1] for r in rows(df.select("n", value_to_double(F.col("v"))))]
    assert doubles == [-2.5, 2.5, 12.0, 12.5, None, None]
    with pytest.raises(PySparkException):
        df.select(value_to_long(F.col("v"), strict=True)).collect()


def test_value_booleans(frame, rows):
    df = _values(frame, "1", "2", '"TRUE"', '"yes"', "false", "[true]")
    assert [r[1] for r in rows(df.select("n", value_to_boolean(F.col("v"))))] == [True, False, True, False, False, None]


def test_struct_path(frame):
    doc = {"obj": {"results": [{"userStatus": "one"}, {"userStatus": "two"}, {"userStatus": None}, {"x": 1}]},
           "deep": [[{"a": 1}], [{"a": [2, None, 3]}]], "other": "y"}
    df = _values(frame, json.dumps(doc))
    pick = lambda *path: df.select(struct_strings(F.col("v"), path)).first()[0]
    assert pick("obj", "results", "userStatus") == ["one", "two"]
    assert pick("deep", "a") == ["1.0", "2.0", "3.0"]
    assert pick("missing", "path") == []
    assert df.select(struct_delimited(F.col("v"), "obj.results.userStatus", ", ")).first()[0] == "one, two"
    for path, delimiter in ((" ", ","), ("a", "")):
        with pytest.raises(ValueError):
            struct_delimited(F.col("v"), path, delimiter)


def test_json_attribute_and_bytes(frame):
    df = frame("j string", ('{"a":{"b":"x","n":5,"o":{"k":1}}}',))
    got = df.select(json_attribute(F.col("j"), ["a", "b"]), json_attribute(F.col("j"), ["a", "n"]),
                    json_attribute(F.col("j"), ["a", "o"]), json_attribute(F.col("j"), ["z"])).first()
    assert tuple(got) == ("x", "5", '{"k":1}', None)
    assert df.select(utf8_bytes(F.lit("æøå"))).first()[0] == 6


def test_map_rules(frame):
    df = frame("a map<string,string>, b map<string,string>", ({"x": "1", "y": "2"}, {"y": "3"}), (None, {"z": "1"}))
    merged = [r[0] for r in df.select(merge_map(F.col("a"), F.col("b"))).collect()]
    assert merged == [{"x": "1", "y": "3"}, {"z": "1"}]
    empty = frame("a map<string,string>, l array<string>", (None, None)).select(
        same_map(F.col("a"), F.create_map().cast("map<string,string>")), same_list(F.col("l"), F.array(F.lit("q")))).first()
    assert tuple(empty) == (True, False)


SQUARE = [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]]
HOLED = SQUARE + [[[1, 1], [3, 1], [3, 3], [1, 3], [1, 1]]]


@pytest.mark.parametrize("shape,relation,expected", [
    ({"type": "Point", "coordinates": [4, 2]}, "INTERSECTS", True),          # on the border
    ({"type": "Point", "coordinates": [5, 2]}, "DISJOINT", True),
    ({"type": "Point", "coordinates": [2, 2]}, "WITHIN", False),             # in the hole
    ({"type": "LineString", "coordinates": [[-1, 2], [5, 2]]}, "INTERSECTS", True),
    ({"type": "LineString", "coordinates": [[0, 0], [4, 0]]}, "WITHIN", True),
    ({"type": "LineString", "coordinates": [[0.5, 2], [3.5, 2]]}, "WITHIN", False),  # through the hole
    ({"type": "Polygon", "coordinates": [[[0.2, 0.2], [0.8, 0.2], [0.8, 0.8], [0.2, 0.2]]]}, "WITHIN", True),
    ({"type": "Polygon", "coordinates": SQUARE}, "WITHIN", False),           # covers the hole
    ({"type": "MultiLineString", "coordinates": [[[9, 9], [8, 8]], [[6, 6], [4, 4]]]}, "INTERSECTS", True),
    ({"type": "MultiPolygon", "coordinates": [[[[9, 9], [8, 9], [8, 8], [9, 9]]]]}, "INTERSECTS", False),
])
def test_geo_relations(frame, shape, relation, expected):
    feature = {"type": "Feature", "geometry": shape, "properties": {"k": 1}}
    df = frame("t string", (json.dumps(feature),)).select(geo.parse_feature(F.col("t")).alias("f"))
    target = {"type": "Polygon", "coordinates": HOLED}
    found = df.where(geo.geo_relation(F.col("f.geometry"), relation, target)).count()
    assert found == int(expected)


def test_feature_round_trip_and_errors(frame):
    text = '{"type":"Feature","geometry":{"type":"MultiPoint","coordinates":[[1.0,2.0],[3.0,4.5]]},"properties":{"a":1}}'
    df = frame("t string", (text,)).select(geo.parse_feature(F.col("t")).alias("f"))
    back = df.select(geo.feature_json(F.col("f.geometry"), F.col("f.properties_json"))).first()[0]
    assert json.loads(back) == json.loads(text)
    assert df.select("f.geometry.max_y").first()[0] == 4.5
    bad = frame("t string", ('{"type":"Feature","geometry":{"type":"Circle","coordinates":[1,2]}}',))
    assert bad.select(geo.parse_feature(F.col("t"), strict=False)).first()[0] is None
    with pytest.raises(PySparkException):
        bad.select(geo.parse_feature(F.col("t"))).collect()


def test_constructors(frame):
    df = frame("x double, y double, flat array<double>", (1.0, 2.0, [0.0, 0.0, 1.0, 1.0]))
    got = df.select(geo.point(F.col("x"), F.col("y"), F.lit(7.0)).alias("p"),
                    geo.line_string(geo.pair_up(F.col("flat"))).alias("l")).first()
    assert got["p"]["coordinates_json"] == "[1.0,2.0,7.0]"
    assert got["l"]["coordinates_json"] == "[[0.0,0.0],[1.0,1.0]]"
    with pytest.raises(PySparkException):
        df.select(geo.line_string(geo.pair_up(F.col("flat"), 3))).collect()
    with pytest.raises(PySparkException):
        df.select(geo.geometry("Point", F.array(F.lit(1.0)))).collect()


def test_hole_of_any_form_is_outside():
    from millrace.functions.geo import _parts, shape_within

    hole = [[2, 2], [8, 2], [8, 8], [7, 8], [7, 3], [3, 3], [3, 8], [2, 8], [2, 2]]
    plate = _parts("Polygon", [[[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]], hole])
    square = lambda a, b: _parts("Polygon", [[[a, a], [b, a], [b, b], [a, b], [a, a]]])
    assert not shape_within(square(1, 9), plate)
    assert shape_within(square(4, 7), plate)


def test_lists_nested_at_any_depth(spark):
    from pyspark.sql import functions as F

    from millrace.functions.values import struct_strings

    rows = [('{"a":[[[[[{"b":"x ]["}]]]],{"b":1}]}',), ('{"a":{"b":[["y"]]}}',), ("{}",), (None,)]
    df = spark.createDataFrame(rows, "j string").select(struct_strings(F.parse_json("j"), ["a", "b"]).alias("s"))
    assert [r["s"] for r in df.collect()] == [["x ][", "1.0"], ['["y"]'], [], []]


def test_within_of_many_shapes_equals_one_by_one():
    import random

    from millrace.functions.geo import _parts, shape_within, within_each

    rng = random.Random(4)
    ring = lambda x, y, w, h: [[x, y], [x + w, y], [x + w, y + h], [x, y + h], [x, y]]
    shapes = [_parts("Point", [rng.randint(-6, 6), rng.randint(-6, 6)]) for _ in range(60)]
    shapes += [_parts("Polygon", [ring(rng.randint(-6, 4), rng.randint(-6, 4), rng.randint(1, 5), rng.randint(1, 5))]) for _ in range(60)]
    shapes += [_parts("LineString", [[rng.randint(-6, 6), rng.randint(-6, 6)] for _ in range(3)]) for _ in range(40)]
    targets = [
        [[[-5, -4], [5, -4], [0, 6], [-5, -4]]], [[[-5, -5], [5, -5], [5, 5], [0, -2], [-5, 5], [-5, -5]]],
        [ring(-6, -6, 11, 11), ring(-2, -2, 3, 3)], [ring(-5, -5, 8, 9)]]
    for rings in targets:
        target = _parts("Polygon", rings)
        assert within_each(shapes, target) == [shape_within(s, target) for s in shapes]
