import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.operators.merge import (
    REPLACE, SPECS, UPDATE, create_only, delete_keys, in_request_order, last_write_wins, merge, resolve_ids, retrieve,
)

ASSET = ("external_id string, name string, description string, parent_external_id string, "
         "metadata map<string,string>, labels array<string>")


def test_update_keeps_what_is_not_given(frame, rows):
    target = frame(ASSET, ("a", "n", "d", "p", {"x": "1", "y": "2"}, ["l1"]), ("b", "n", None, None, None, None))
    source = frame(ASSET, ("a", None, "new", None, {"y": "3"}, ["l2"]), ("b", "m", None, "q", {}, []), ("c", "x", None, None, {}, None))
    got = {r[0]: r[1:] for r in merge(target, source, SPECS["assets"], UPDATE).collect()}
    assert got["a"] == ("n", "new", "p", {"x": "1", "y": "3"}, ["l1", "l2"], "updated")
    assert got["b"] == ("m", None, "q", None, None, "updated")
    assert got["c"][0] == "x" and got["c"][-1] == "created"


def test_replace_clears_but_keeps_parent(frame):
    target = frame(ASSET, ("a", "n", "d", "p", {"x": "1"}, ["l1"]))
    source = frame(ASSET, ("a", "m", None, None, None, ["l2"]))
    got = merge(target, source, SPECS["assets"], REPLACE).first()
    assert tuple(got) == ("a", "m", None, "p", {}, ["l2"], "updated")
    with pytest.raises(PySparkException):
        merge(target, frame(ASSET, ("a", None, "d", None, None, None)), SPECS["assets"], REPLACE).collect()


def test_merge_is_idempotent(frame, rows):
    target = frame(ASSET, ("a", "n", "d", "p", {"x": "1"}, ["l1"]))
    source = frame(ASSET, ("a", None, None, None, {"y": "2"}, ["l2"]), ("c", "x", None, None, None, None))
    once = merge(target, source, SPECS["assets"]).drop("_change")
    twice = merge(once, source, SPECS["assets"]).drop("_change")
    assert rows(once) == rows(twice)


def test_source_duplicates_and_order(frame):
    target = frame("external_id string, name string, type string", ("a", "n", "t"))
    source = frame("external_id string, name string, ord int", ("a", "late", 2), ("a", "early", 1))
    got = merge(target, source, SPECS["events"], order_by=["ord"]).first()
    assert tuple(got) == ("a", "late", "t", "updated")


def test_null_key_is_an_error(frame):
    target = frame("external_id string, name string", ("a", "n"))
    with pytest.raises(PySparkException):
        merge(target, frame("external_id string, name string", (None, "x")), SPECS["events"]).collect()


def test_time_series_unit_rules(frame):
    ddl = "external_id string, unit string, unit_external_id string, is_string boolean"
    target = frame(ddl, ("a", "bar", "u:bar", False), ("b", "bar", "u:bar", False), ("c", "bar", "u:bar", False))
    source = frame(ddl, ("a", None, None, True), ("b", " ", " ", True), ("c", "psi", "u:psi", True))
    got = {r[0]: tuple(r[1:4]) for r in merge(target, source, SPECS["timeseries"]).collect()}
    assert got == {"a": (None, "u:bar", False), "b": (None, None, False), "c": ("psi", "u:psi", False)}


def test_other_resource_rules(frame):
    files = merge(frame("external_id string, name string, asset_ids array<long>", ("f", "n", [1])),
                  frame("external_id string, name string, asset_ids array<long>", ("f", "other", [2, 3])), SPECS["files"]).first()
    assert tuple(files)[:3] == ("f", "n", [2, 3])
    ddl = "external_id string, metadata map<string,string>, write_protected boolean"
    target = frame(ddl, ("d", {"x": "1"}, True))
    assert merge(target, frame(ddl, ("d", None, None)), SPECS["data_sets"]).first()["metadata"] == {}
    assert merge(target, frame(ddl, ("d", None, None)), SPECS["data_sets"], REPLACE).first()["write_protected"] is False
    feeds = "external_id string, name string, contacts array<string>"
    target = frame(feeds, ("p", "n", ["c1"]))
    added = merge(target, frame(feeds, ("p", None, ["c2"])), SPECS["extraction_feeds"]).first()
    assert (added["name"], added["contacts"]) == (None, ["c1", "c2"])
    replaced = merge(target, frame(feeds, ("p", "m", ["c2"])), SPECS["extraction_feeds"], REPLACE).first()
    assert replaced["contacts"] == ["c2"]


def test_last_write_wins_ties_are_stable(frame, rows):
    df = frame("k string, v string, ord int", ("a", "x", 1), ("a", "y", 1), ("b", "z", 0))
    assert rows(last_write_wins(df, ["k"], ["ord"])) == rows(last_write_wins(df.orderBy("v"), ["k"], ["ord"]))
    assert last_write_wins(frame("k string", ("a",), ("a",)), ["k"]).count() == 1


def test_create_only(frame, rows):
    target = frame("external_id string, v int", ("a", 1))
    assert rows(create_only(target, frame("external_id string, v int", ("b", 2)), ["external_id"])) == [("a", 1), ("b", 2)]
    for clash in (("a", 2),), (("b", 1), ("b", 2)):
        with pytest.raises(PySparkException):
            create_only(target, frame("external_id string, v int", *clash), ["external_id"]).collect()


def test_delete(frame, rows):
    df = frame("external_id string, v int", ("a", 1), ("b", 2))
    wanted = frame("external_id string", ("a",), ("a",), ("zz",))
    left, gone = delete_keys(df, wanted, ["external_id"])
    assert rows(left) == [("b", 2)] and rows(gone) == [("a",)]
    with pytest.raises(ValueError):
        delete_keys(df, wanted, ["external_id"], ignore_unknown=False)


def test_retrieve_keeps_key_kinds_apart(frame, rows):
    df = frame("id long, external_id string", (10, "ten"), (11, "10"), (12, "x"))
    items = frame("external_id string, id long", ("10", None), (None, 10), ("10", None), (None, 99), (None, 11))
    assert rows(retrieve(df, items)) == [(10, "ten"), (11, "10")]
    with pytest.raises(Exception, match="item without id"):
        retrieve(df, frame("external_id string, id long", (None, None))).collect()
    assert [r["id"] for r in in_request_order(df, ["x", "10", "x", "none"]).collect()] == [12, 11]
    filled = resolve_ids(frame("id long, external_id string, v int", (10, None, 1), (None, "x", 2), (99, None, 3)), df)
    assert rows(filled, "external_id", "v") == [("ten", 1), ("x", 2), (None, 3)]


def test_create_only_counts_and_filters(frame):
    target = frame("external_id string, v int", ("a", 1))
    fresh = frame("external_id string, v int", ("n1", 1), ("n2", 2))
    made = create_only(target, fresh, ["external_id"])
    assert made.where("external_id = 'n1'").count() == 1 and made.count() == 3
    for rows in ([("a", 2)], [("n1", 1), ("n1", 2)], [(None, 1)]):
        with pytest.raises(ValueError):
            create_only(target, frame("external_id string, v int", *rows), ["external_id"]).count()
