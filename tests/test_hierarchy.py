import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.hierarchy import (
    apply_sync, ascend, asset_properties, change_counts, components, cycle_members, delete_assets, is_sound, subtree,
    sync_plan, topological_rank, upsert_assets, violation_report, violations,
)

TREE = "external_id string, parent_external_id string"


def tree(frame, *pairs):
    return frame(TREE, *pairs)


def test_sound_tree(frame):
    assert is_sound(tree(frame, ("r", None), ("a", "r"), ("b", "a")))


@pytest.mark.parametrize("pairs,expected", [
    ([(None, "r"), ("r", None)], {("missing_external_id", None)}),
    ([("r", None), ("a", "r"), ("a", "r")], {("duplicate", "a")}),
    ([("r", None), ("a", "a")], {("self_reference", "a"), ("cycle", "a")}),
    ([("r", None), ("a", "b"), ("b", "a"), ("t", "a"), ("u", "t")], {("cycle", "a"), ("cycle", "b")}),
    ([("r", None), ("a", "b"), ("b", "c"), ("c", "a"), ("t", "c")], {("cycle", "a"), ("cycle", "b"), ("cycle", "c")}),
    ([("r", None), ("q", " ")], {("root_count", "r"), ("root_count", "q")}),
    ([("r", None), ("a", "gone")], {("missing_parent", "a")}),
    ([("a", "gone")], {("root_count", None), ("missing_parent", "a")}),
])
def test_violations(frame, pairs, expected):
    found = {tuple(r) for r in violations(tree(frame, *pairs)).collect()}
    assert found == expected


def test_empty_input_has_no_root(frame):
    assert [tuple(r) for r in violations(tree(frame)).collect()] == [("root_count", None)]


def test_report_caps_samples_not_counts(frame):
    found = frame("rule string, external_id string", *[("duplicate", f"{i:03}") for i in range(150)])
    row = violation_report(found).first()
    assert (row["violations"], len(row["samples"]), row["samples"][0]) == (150, 100, "000")


def test_long_chain_and_tail_below_a_cycle(frame):
    chain = [("0", None)] + [(str(i), str(i - 1)) for i in range(1, 70)]
    tail = [("x", "y"), ("y", "x"), ("t0", "x")] + [(f"t{i}", f"t{i - 1}") for i in range(1, 20)]
    up = ascend(tree(frame, *chain, *tail))
    assert {r["depth"] for r in up.reached.collect()} == set(range(70))
    assert up.endless_count == 22
    assert {r[0] for r in cycle_members(up).collect()} == {"x", "y"}


def test_random_functional_graphs(frame):
    rng = random.Random(3)
    for _ in range(3):
        n = 40
        parent = {str(i): (str(rng.randrange(n)) if rng.random() < 0.9 else None) for i in range(n)}
        df = tree(frame, *parent.items())
        on_cycle, label = set(), {}
        for node in parent:
            seen, at = [], node
            while at is not None and at not in seen:
                seen.append(at)
                at = parent[at]
            if at is None:
                label[node] = seen[-1]
            else:
                ring = seen[seen.index(at):]
                label[node] = min(ring)
                on_cycle.update(ring)
        assert {r[0] for r in cycle_members(ascend(df)).collect()} == on_cycle
        assert {r[0]: r[1] for r in components(df).collect()} == label


def test_rank_properties_subtree(frame, rows):
    df = tree(frame, ("r", None), ("a", "r"), ("b", "r"), ("c", "a"), ("out", "elsewhere"))
    assert rows(topological_rank(df), "external_id", "order_rank") == [("a", 1), ("b", 1), ("c", 2), ("out", 0), ("r", 0)]
    props = {r["external_id"]: r for r in asset_properties(df).collect()}
    assert props["c"]["path"] == ["r", "a", "c"] and props["c"]["depth"] == 2
    assert props["r"]["child_count"] == 2 and props["r"]["path"] == ["r"]
    assert [r[0] for r in rows(subtree(df, ["a", "b"]), "external_id")] == ["a", "b", "c"]
    assert [r[0] for r in rows(subtree(df, ["r", "a"]), "external_id")] == ["a", "b", "c", "r"]
    with pytest.raises(ValueError):
        topological_rank(tree(frame, ("a", "b"), ("b", "a")))


def test_delete(frame, rows):
    df = tree(frame, ("r", None), ("a", "r"), ("c", "a"))
    one = lambda *ids: frame("external_id string", *[(i,) for i in ids])
    assert [r[0] for r in rows(delete_assets(df, one("a"), recursive=True))] == ["r"]
    assert [r[0] for r in rows(delete_assets(df, one("a", "c")))] == ["r"]
    with pytest.raises(ValueError):
        delete_assets(df, one("a"))


ASSET = TREE + ", name string, metadata map<string,string>, labels array<string>, geo_location string"


def assets(frame, *rows):
    return frame(ASSET, *rows)


BASE = [("r", None, "root", {"k": "1"}, ["x", "y"], "g"), ("a", "r", "A", None, None, None), ("b", "r", "B", {}, [], None),
        ("c", "a", "C", None, None, None)]


def change_of(plan):
    return {r["external_id"]: r["change"] for r in plan.collect()}


def test_same_input_gives_an_empty_plan(frame):
    assert set(change_of(sync_plan(assets(frame, *BASE), assets(frame, *BASE))).values()) == {"unchanged"}


def test_field_sensitivity(frame):
    edited = [("r", None, "root", {"k": "2"}, ["x", "y"], "g"), ("a", "r", "A", {}, [], "elsewhere"),
              ("b", "r", "B", None, None, None), ("c", "a", "C", None, None, None)]
    assert change_of(sync_plan(assets(frame, *edited), assets(frame, *BASE))) == {
        "r": "changed", "a": "unchanged", "b": "unchanged", "c": "unchanged"}
    order = [("r", None, "root", {"k": "1"}, ["y", "x"], "g"), *BASE[1:]]
    assert change_of(sync_plan(assets(frame, *order), assets(frame, *BASE)))["r"] == "changed"
    geo = sync_plan(assets(frame, *edited), assets(frame, *BASE), include_geo=True)
    assert change_of(geo)["a"] == "changed"


def test_sync_edit_add_remove(frame, rows):
    outside = ("other", None, "other root", None, None, None)
    existing = assets(frame, *BASE, outside)
    incoming = assets(frame, BASE[0], ("a", "r", "A2", None, None, None), ("n", "a", "N", None, None, None),
                      ("m", "n", "M", None, None, None))
    plan = sync_plan(incoming, existing)
    got = {r["external_id"]: (r["change"], r["order_rank"]) for r in plan.collect()}
    assert got == {"r": ("unchanged", 0), "a": ("changed", 1), "n": ("new", 2), "m": ("new", 3),
                   "b": ("deleted", -1), "c": ("deleted", -2)}
    after = apply_sync(incoming, existing, plan)
    assert rows(after, "external_id", "name") == [("a", "A2"), ("m", "M"), ("n", "N"), ("other", "other root"), ("r", "root")]
    assert {r[0]: r[1] for r in change_counts(plan).collect()} == {"unchanged": 1, "changed": 1, "new": 2, "deleted": 2}
    assert set(change_of(sync_plan(incoming, after)).values()) == {"unchanged"}


def test_unsound_input_is_refused(frame):
    with pytest.raises(ValueError):
        sync_plan(assets(frame, ("a", "b", "A", None, None, None)), assets(frame, *BASE))


def test_many_hierarchies_and_moves(frame):
    second = [("s", None, "second", None, None, None), ("t", "s", "T", None, None, None)]
    existing = assets(frame, *BASE, *second)
    moved = [*BASE[:3], ("t", "a", "T", None, None, None), second[0]]
    plan = {r["external_id"]: (r["change"], r["component"]) for r in
            sync_plan(assets(frame, *moved), existing, many=True).collect()}
    assert plan["t"] == ("changed", "r") and plan["c"] == ("deleted", "r") and plan["s"] == ("unchanged", "s")


def test_asset_upsert_checks_first(frame, rows):
    with pytest.raises(ValueError):
        upsert_assets(assets(frame, *BASE), assets(frame, ("z", "z", "Z", None, None, None)))
    after = upsert_assets(assets(frame, *BASE), assets(frame, ("z", "a", "Z", None, None, None), ("a", None, "AA", None, None, None)))
    assert {r["external_id"]: r["parent_external_id"] for r in after.collect()}["a"] == "r"
