"""Components and cycles of edge lists, and of hierarchies whose ids have several parents."""

import random

import pytest

from millrace.operators.components import strong_components, weak_components
from millrace.operators.hierarchy import components, cycles, violations

NODE = "external_id string, parent_external_id string"


def closure(edges):
    """All (a, b) with a way from a to b along edges."""
    out = {}
    for a, b in edges:
        out.setdefault(a, set()).add(b)
    found = set()
    for start in out:
        stack, seen = list(out[start]), set()
        while stack:
            x = stack.pop()
            if x not in seen:
                seen.add(x)
                stack += out.get(x, ())
        found |= {(start, x) for x in seen}
    return found


@pytest.mark.parametrize("seed", [1])
def test_edge_lists(frame, rows, seed):
    rng = random.Random(seed)
    n = 40
    edges = {(rng.randrange(n), rng.randrange(n)) for _ in range(44)} | {(100, 101), (101, 102), (102, 100), (103, 100), (104, 104)}
    table = frame("a long, b long", *edges)
    way = closure(edges)
    want = {x: max(y for y in range(200) if (x, y) in way and (y, x) in way) for x, y in way if x == y}
    assert dict(rows(strong_components(table))) == want
    both = closure(edges | {(b, a) for a, b in edges})
    assert dict(rows(weak_components(table))) == {x: min(y for y in range(200) if (x, y) in both) for x, y in both if x != y}


def test_ids_of_two_parents_are_one_component(frame, rows):
    nodes = frame(NODE, ("r", None), ("z", None), ("a", "r"), ("a", "z"), ("q", ""), ("s", "outside"))
    assert rows(components(nodes)) == [("a", "r"), ("q", "q"), ("r", "r"), ("s", "s"), ("z", "r")]
    assert rows(cycles(nodes)) == []


def test_cycles_through_the_lesser_parent(frame, rows):
    """The way b-c-d-b uses the parent of b that sorts first; e hangs below, f is a ring of its own."""
    nodes = frame(NODE, ("top", None), ("b", "d"), ("b", "top"), ("c", "b"), ("d", "c"), ("e", "d"), ("f", "g"), ("g", "f"), ("h", "h"))
    assert rows(cycles(nodes)) == [("b",), ("c",), ("d",), ("f",), ("g",), ("h",)]
    assert rows(components(nodes)) == [(x, "top") for x in "bcde"] + [("f", "f"), ("g", "f"), ("h", "h"), ("top", "top")]
    found = {r["external_id"] for r in violations(nodes).where("rule = 'cycle'").collect()}
    assert found == {"b", "c", "d", "f", "g", "h"}


@pytest.mark.parametrize("seed", [1])
def test_against_brute_force(frame, rows, seed):
    rng = random.Random(100 + seed)
    names = [f"n{i:02}" for i in range(30)]
    given = [(x, rng.choice([None, *names[:i]]) if i and rng.random() < 0.9 else None) for i, x in enumerate(names)]
    given += [(rng.choice(names), rng.choice(names)) for _ in range(4)] + [(names[3], "elsewhere")]
    edges = {(a, b) for a, b in given if b in names}
    way, both = closure(edges), closure(edges | {(b, a) for a, b in edges})
    ring = {a for a, b in way if a == b}
    assert [r[0] for r in rows(cycles(frame(NODE, *given)))] == sorted(ring)
    name = {}
    for x in names:
        mates = {x} | {y for y in names if (x, y) in both}
        roots = {y for y in mates if not any(a == y for a, _ in edges)}
        name[x] = min(roots or mates & ring)
    assert dict(rows(components(frame(NODE, *given)))) == name


def test_parent_edges_are_made_once(spark, monkeypatch):
    from millrace.operators import hierarchy

    calls, plain = [], hierarchy.parent_edges
    monkeypatch.setattr(hierarchy, "parent_edges", lambda nodes: calls.append(1) or plain(nodes))
    nodes = spark.createDataFrame([("a", None), ("b", "a"), ("b", "c"), ("c", "b"), ("d", "b")], "external_id string, parent_external_id string")
    got = {tuple(r) for r in hierarchy.components(nodes).collect()}
    assert got == {(x, "a") for x in "abcd"} and len(calls) == 1
