"""Join-based filter keys on rows without a key, with repeated keys and with unknown data sets."""

import pytest

from millrace.plans.filters import apply_filter, linked_to

EV = "n int, external_id string, asset_ids array<string>, data_set_id long"


@pytest.fixture
def events(frame):
    return frame(EV, (1, None, ["a"], 4), (2, "k", ["a", "b"], 9), (3, "k", ["c"], 4), (4, "m", None, None), (5, None, [], 5),
                 (6, None, ["b", None, "b"], 9), (7, None, ["b", None, "b"], 9))


def test_each_row_is_judged_by_its_own_links(frame, rows, events):
    assert rows(linked_to(events, frame("external_id string", ("a",))), "n") == [(1,), (2,)]
    assert rows(linked_to(events, frame("external_id string", ("b",), ("b",), (None,))), "n") == [(2,), (6,), (7,)]
    assert rows(linked_to(events, frame("external_id string", ("c",))), "n") == [(3,)]
    assert rows(linked_to(events, frame("external_id string")), "n") == []


@pytest.mark.parametrize("ids, want", [
    ([9, {"externalId": "d4"}], [1, 2, 3, 6, 7]), ([9], [2, 6, 7]), ([{"id": 9}, {"externalId": "d5"}], [2, 5, 6, 7]),
    ([{"externalId": "none"}], []), ([8, {"externalId": "none"}], [])])
def test_data_sets(frame, rows, events, ids, want):
    sets = frame("id long, external_id string", (4, "d4"), (5, "d5"))
    got = apply_filter(events, {"dataSetIds": ids}, {"data_sets": sets})
    assert [r[0] for r in rows(got, "n")] == want


def test_subtree_of_rows_without_keys(frame, rows, events):
    assets = frame("id long, external_id string, parent_external_id string", (1, "top", None), (2, "a", "top"), (3, "b", "a"), (4, "c", None))
    got = apply_filter(events, {"assetSubtreeIds": [{"externalId": "a"}]}, {"assets": assets})
    assert rows(got, "n") == [(1,), (2,), (6,), (7,)]
    assert rows(apply_filter(events, {"rootAssetIds": ["top"]}, {"assets": assets}), "n") == [(1,), (2,), (6,), (7,)]


def test_resources_take_two_joins(frame):
    from millrace.operators.graph import with_resources

    edges = frame("external_id string, source_type string, source_external_id string, target_type string, target_external_id string",
                  ("r", "asset", "1", "file", "9"), ("s", "asset", "2", "asset", "1"))
    found = with_resources(edges, {"asset": frame("external_id string, name string", ("1", "a"), ("7", "b"), (None, "c")),
                                   "file": frame("external_id string, name string", ("9", "f"))})
    got = {r["external_id"]: (r["s"], r["t"]) for r in found.selectExpr(
        "external_id", "try_variant_get(source, '$.name', 'string') s", "try_variant_get(target, '$.name', 'string') t").collect()}
    assert got == {"r": ("a", "f"), "s": (None, "a")}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2 and "LeftSemi" not in plan
