"""Asset hierarchies: integrity, cycles, components, order, subtrees, synchronisation.

A hierarchy is a frame with ``external_id`` and ``parent_external_id``. The jobs
double parent pointers: after k rounds every node looks 2^k levels up, so a tree
of depth d takes about log2(d) equi joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.functions.collections import same_list, same_map
from millrace.lineage import materialize, materialize_counted
from millrace.operators.components import strong_components, weak_components
from millrace.operators.merge import REPLACE, SPECS, MergeSpec, merge

ID, PARENT = "external_id", "parent_external_id"

# The fields compared for change detection.
COMPARED_FIELDS = ("name", "parent_external_id", "description", "metadata", "source", "data_set_id", "labels")


def is_root(parent: Column) -> Column:
    """A blank or unset parent."""
    return F.trim(F.coalesce(parent, F.lit(""))) == ""


def _edges(nodes: DataFrame) -> DataFrame:
    """One row per id: ``(id, parent)``; a blank parent becomes null."""
    parent = F.when(~is_root(F.col(PARENT)), F.col(PARENT))
    return (
        nodes.where(F.col(ID).isNotNull())
        .groupBy(F.col(ID).alias("id")).agg(F.max(parent).alias("parent"))
    )


@dataclass
class Ascent:
    """Where every node's parent chain ends.

    ``reached``: ``(id, top, depth[, chain])`` of nodes whose chain ends at a root
    (or a stop node); ``chain`` lists the ids from just below the top to the node.
    ``endless``: ``(id, top, label)`` of nodes on or below a cycle, ``top`` being a
    cycle member and ``label`` the least id met on the way up and around.
    """

    reached: DataFrame
    endless: DataFrame
    endless_count: int


def ascend(nodes: DataFrame, stops: DataFrame | None = None, with_chain: bool = False) -> Ascent:
    """Follow parent pointers to the top by pointer doubling.

    A node without a parent inside ``nodes`` is a top, as are the ids in
    ``stops(id)``. Settled nodes leave the working set; each round is written to
    the shared folder, so lineage stays one round deep.
    """
    edges = _edges(nodes)
    known = edges.select(F.col("id").alias("parent"), F.col("parent").isNull().alias("_under_root"))
    start = edges.join(known, "parent", "left")
    settled = F.col("_under_root").isNull()
    if stops is not None:
        marks = stops.select(F.col(stops.columns[0]).alias("id"), F.lit(True).alias("_stop")).distinct()
        start = start.join(marks, "id", "left")
        settled = settled | F.col("_stop").isNotNull()
    chain = [F.when(settled, F.array().cast("array<string>")).otherwise(F.array("id")).alias("chain")] if with_chain else []
    state, count = materialize_counted(start.select(
        "id",
        F.when(settled, F.col("id")).otherwise(F.col("parent")).alias("top"),
        F.when(settled, F.lit(0)).otherwise(F.lit(1)).cast("long").alias("depth"),
        (settled | F.col("_under_root")).alias("done"),
        F.when(settled, F.col("id")).otherwise(F.least("id", "parent")).alias("label"),
        *chain,
    ), ~F.col("done"), "ascend")

    finished = [state.where("done")]
    active = state.where("NOT done")
    reach, cyclic = 1, False
    while count and not (cyclic and reach >= count):
        # Everything above an endless node is endless too.
        lookup = active if cyclic else reduce(DataFrame.unionByName, [*finished, active])
        up = lookup.select(
            F.col("id").alias("top"), F.col("top").alias("_top"), F.col("depth").alias("_depth"),
            F.col("done").alias("_done"), F.col("label").alias("_label"),
            *([F.col("chain").alias("_chain")] if with_chain else []),
        )
        # Chains of endless nodes would only grow, so they are dropped once known.
        longer = [F.when(F.lit(cyclic), F.col("chain")).otherwise(F.concat("_chain", "chain")).alias("chain")] if with_chain else []
        state, left = materialize_counted(active.drop("done").join(up, "top").select(
            "id", F.col("_top").alias("top"), (F.col("depth") + F.col("_depth")).alias("depth"),
            F.col("_done").alias("done"), F.least("label", "_label").alias("label"), *longer,
        ), ~F.col("done"), "ascend")
        finished.append(state.where("done"))
        active = state.where("NOT done")
        # Depths are contiguous: a round that settles nobody leaves only cycles.
        cyclic = cyclic or left == count
        count, reach = left, reach * 2

    reached = reduce(DataFrame.unionByName, finished).drop("done", "label")
    return Ascent(reached, active.select("id", "top", "label"), count)


def cycle_members(ascent: Ascent) -> DataFrame:
    """Ids that lie on a cycle; nodes merely below one are left out."""
    return ascent.endless.select(F.col("top").alias(ID)).distinct()


def parent_edges(nodes: DataFrame) -> DataFrame:
    """Distinct ``(id, parent)`` of all rows whose parent is an id of the input; an id may come with several."""
    rows = nodes.where(F.col(ID).isNotNull() & ~is_root(F.col(PARENT))).select(
        F.col(ID).alias("id"), F.col(PARENT).alias("parent")).distinct()
    known = nodes.where(F.col(ID).isNotNull()).select(F.col(ID).alias("parent")).distinct()
    return rows.join(known, "parent", "left_semi").select("id", "parent")


def several_parents(nodes: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """``(id)`` of the ids that come with more than one parent in the input; ``edges`` are its parent edges."""
    return (edges or parent_edges(nodes)).groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")


def cycles(nodes: DataFrame, ascent: Ascent | None = None, edges: DataFrame | None = None) -> DataFrame:
    """Ids on a cycle, whichever of their parents it runs through; ``edges`` are the parent edges, where known.

    Where ids have several parents, chains of single parents are climbed first, by doubling: what is left are
    the ids of several parents and the one each of their parents' chains ends at. Strong components of
    that small graph, with the chains between their members, are the cycles through them.
    """
    edges = edges or materialize(parent_edges(nodes), "parents")
    crossing = materialize(several_parents(nodes, edges), "crossing")
    if crossing.isEmpty():
        return cycle_members(ascent or ascend(nodes))
    tops = crossing.select(F.col("id").alias("top"))
    first = materialize(edges.join(crossing, "id", "left_semi"), "crossing")
    up = ascend(nodes, crossing)
    ways = materialize(first.join(up.reached.select(F.col("id").alias("parent"), "top"), "parent").join(tops, "top", "left_semi"), "ways")
    plain = cycle_members(up)
    if ways.isEmpty():
        return plain
    strong = materialize(strong_components(ways.select(F.col("id").alias("a"), F.col("top").alias("b"))), "rings")
    if strong.isEmpty():
        return plain
    ends = strong.select(F.col("node").alias("top"), F.col("component").alias("_there"))
    inside = ways.join(strong.select(F.col("node").alias("id"), "component"), "id").join(ends, "top").where("component = _there")
    # Only now the ids between the members are needed.
    chains = ascend(nodes, crossing, with_chain=True).reached.select(F.col("id").alias("parent"), "chain")
    between = inside.select("parent").distinct().join(chains, "parent").select(F.explode("chain").alias(ID))
    return plain.union(strong.select(F.col("node").alias(ID))).union(between).distinct()


def components(nodes: DataFrame) -> DataFrame:
    """``(external_id, component)``: ids that parents connect, named by their root, or the least id around a cycle.

    Ids with several parents connect all of them; of several roots the least names the component.
    """
    edges = materialize(parent_edges(nodes), "parents")
    if not several_parents(nodes, edges).isEmpty():
        ids = nodes.where(F.col(ID).isNotNull()).select(ID).distinct()
        linked = materialize(weak_components(edges.select(F.col("id").alias("a"), F.col("parent").alias("b"))), "weak")
        placed = ids.join(linked.withColumnRenamed("node", ID), ID, "left").withColumn("component", F.coalesce("component", ID))
        below = edges.select(F.col("id").alias(ID), F.lit(True).alias("_below")).distinct()
        rings = cycles(nodes, edges=edges).select(ID, F.lit(True).alias("_ring"))
        placed = materialize(placed.join(below, ID, "left").join(rings, ID, "left"), "placed")
        names = placed.groupBy("component").agg(F.coalesce(
            F.min(F.when(F.col("_below").isNull(), F.col(ID))), F.min(F.when(F.col("_ring"), F.col(ID)))).alias("_name"))
        return placed.join(names, "component").select(ID, F.col("_name").alias("component"))
    up = ascend(nodes)
    # The label of a ring member covers its ring only; below a ring it covers the tail too.
    labels = up.endless.select(F.col("id").alias("top"), F.col("label").alias("component"))
    rings = up.endless.join(labels, "top").select(F.col("id").alias(ID), "component")
    return up.reached.select(F.col("id").alias(ID), F.col("top").alias("component")).unionByName(rings)


def topological_rank(nodes: DataFrame) -> DataFrame:
    """``nodes`` plus ``order_rank``: parents before children, the reverse order for deletes.

    A parent outside the input counts as safe. A cycle is an error.
    """
    up = ascend(nodes)
    if up.endless_count:
        raise ValueError(f"hierarchy has a cycle: {up.endless_count} nodes on or below it")
    return nodes.join(up.reached.select(F.col("id").alias(ID), F.col("depth").alias("order_rank")), ID)


def child_counts(nodes: DataFrame) -> DataFrame:
    parents = nodes.where(~is_root(F.col(PARENT)))
    return parents.groupBy(F.col(PARENT).alias(ID)).agg(F.count(F.lit(1)).alias("child_count"))


def asset_properties(nodes: DataFrame) -> DataFrame:
    """``(external_id, root_external_id, depth, path, child_count)``; path runs root to node."""
    up = ascend(nodes, with_chain=True)
    props = up.reached.select(
        F.col("id").alias(ID), F.col("top").alias("root_external_id"), "depth",
        F.concat(F.array("top"), "chain").alias("path"),
    )
    return props.join(child_counts(nodes), ID, "left").withColumn(
        "child_count", F.coalesce("child_count", F.lit(0)).cast("long")
    )


def root_names(nodes: DataFrame) -> DataFrame:
    """``nodes`` plus ``root_external_id`` and ``root_name``."""
    tops = ascend(nodes).reached.select(F.col("id").alias(ID), F.col("top").alias("root_external_id"))
    names = nodes.select(F.col(ID).alias("root_external_id"), F.col("name").alias("root_name"))
    return nodes.join(tops, ID, "left").join(names, "root_external_id", "left")


def subtree(nodes: DataFrame, roots: Sequence[str] | DataFrame) -> DataFrame:
    """Nodes of the subtrees under ``roots``, the roots included."""
    if isinstance(roots, DataFrame):
        stops = roots.select(F.col(roots.columns[0]).alias("id")).distinct()
    else:
        stops = nodes.sparkSession.createDataFrame([(r,) for r in dict.fromkeys(roots)], "id string")
    members = ascend(nodes, stops).reached
    inside = members.join(stops.select(F.col("id").alias("top")), "top")
    return nodes.join(inside.select(F.col("id").alias(ID)), ID).select(*nodes.columns)


def children(nodes: DataFrame) -> DataFrame:
    """``(parent_external_id, external_id)`` pairs whose parent is in the input."""
    ids = nodes.select(F.col(ID).alias(PARENT)).distinct()
    return nodes.select(PARENT, ID).join(ids, PARENT)


# -------------------------------------------------------------------- integrity

RULES = ("missing_external_id", "duplicate", "self_reference", "cycle", "root_count", "missing_parent")


def violations(nodes: DataFrame, single_root: bool = True, ascent: Ascent | None = None) -> DataFrame:
    """``(rule, external_id)`` of every broken rule; empty means the hierarchy is sound.

    A self-reference is reported by its own rule and is also a cycle of one.
    """
    row = lambda rule: F.lit(rule).alias("rule")
    keyed = nodes.where(F.col(ID).isNotNull())
    found = [
        nodes.where(F.col(ID).isNull()).select(row("missing_external_id"), ID),
        cycles(nodes, ascent).select(row("cycle"), ID),
    ]
    several_roots = False
    if single_root:
        n = keyed.where(is_root(F.col(PARENT))).select(ID).distinct().limit(2).count()
        several_roots = n > 1
        if n == 0:
            none = nodes.sparkSession.range(1).select(row("root_count"), F.lit(None).cast("string").alias(ID))
            found.append(none)
        ids = keyed.select(F.col(ID).alias(PARENT), F.lit(True).alias("_known")).distinct()
        children_of = keyed.select(PARENT, ID).where(~is_root(F.col(PARENT))).join(ids, PARENT, "left")
        found.append(children_of.where(F.col("_known").isNull()).select(row("missing_parent"), ID).distinct())
    per_id = keyed.groupBy(ID).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col(PARENT) == F.col(ID)).alias("own"),
        F.max(is_root(F.col(PARENT))).alias("root"),
    )
    broken = F.array(
        F.when(F.col("n") > 1, "duplicate"), F.when(F.col("own"), "self_reference"),
        F.when(F.col("root") & F.lit(several_roots), "root_count"),
    )
    found.append(per_id.select(F.explode(F.array_compact(broken)).alias("rule"), ID))
    return reduce(DataFrame.unionByName, found)


def is_sound(nodes: DataFrame, single_root: bool = True) -> bool:
    return violations(nodes, single_root).isEmpty()


def violation_report(found: DataFrame, samples: int = 100) -> DataFrame:
    """``(rule, violations, samples)`` with at most ``samples`` ids listed per rule.

    The rank filter is applied before the shuffle, so no task holds a whole rule.
    """
    first = W.partitionBy("rule").orderBy(ID)
    listed = (
        found.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= samples)
        .groupBy("rule").agg(F.sort_array(F.collect_list(ID)).alias("samples"))
    )
    counts = found.groupBy("rule").agg(F.count(F.lit(1)).alias("violations"))
    return counts.join(listed, "rule")


# -------------------------------------------------------------- synchronisation

def same_record(a: str, b: str, columns: Sequence[str], include_geo: bool = False) -> Column:
    """Field-wise equality of two struct columns; geo location only when asked for."""
    wanted = [c for c in COMPARED_FIELDS if c in columns]
    if include_geo and "geo_location" in columns:
        wanted.append("geo_location")
    test = F.lit(True)
    for c in wanted:
        x, y = F.col(a)[c], F.col(b)[c]
        if c == "metadata":
            test = test & same_map(x, y)
        elif c == "labels":
            test = test & same_list(x, y)
        else:
            test = test & x.eqNullSafe(y)
    return test


def _change(columns: Sequence[str], include_geo: bool) -> Column:
    """Kind of change between the structs ``_in`` and ``_ex``; a side that is missing is null."""
    return (
        F.when(F.col("_ex").isNull(), "new").when(F.col("_in").isNull(), "deleted")
        .when(same_record("_in", "_ex", columns, include_geo), "unchanged").otherwise("changed")
    )


def diff(incoming: DataFrame, existing: DataFrame, key: str = ID, include_geo: bool = False) -> DataFrame:
    """``(key, change)``: new, changed, unchanged or deleted."""
    shared = [c for c in incoming.columns if c in existing.columns and c != key]
    a = incoming.select(key, F.struct(*shared).alias("_in"))
    b = existing.select(key, F.struct(*shared).alias("_ex"))
    return a.join(b, key, "full_outer").select(key, _change(shared, include_geo).alias("change"))


def sync_plan(incoming: DataFrame, existing: DataFrame, verify: bool = True, many: bool = False,
              include_geo: bool = False) -> DataFrame:
    """``(external_id, component, change, order_rank)`` to turn the existing trees into the incoming.

    Existing rows count as far as they hang under the incoming roots. ``order_rank``
    is the depth for upserts (parents first) and minus the depth for deletes (leaves first). With
    ``many`` the input may hold several hierarchies, and a root is never deleted.
    """
    up = ascend(incoming)
    if verify:
        broken = violations(incoming, not many, up)
        sample = broken.limit(10).collect()
        if sample:
            raise ValueError(f"hierarchy is not sound: {[tuple(r) for r in sample]}")
    new_up = up.reached.select(
        F.col("id").alias(ID), F.col("top").alias("_new_top"), F.col("depth").alias("_new_depth")
    )
    roots = new_up.select(F.col("_new_top").alias("id")).distinct()
    old_up = ascend(existing, roots).reached
    inside = old_up.join(roots.select(F.col("id").alias("top")), "top").select(
        F.col("id").alias(ID), F.col("top").alias("_old_top"), F.col("depth").alias("_old_depth")
    )
    shared = [c for c in incoming.columns if c in existing.columns and c != ID]
    # Both sides are on the key already when they meet, so the full join adds no shuffle.
    a = incoming.select(ID, F.struct(*shared).alias("_in")).join(new_up, ID)
    b = existing.select(ID, F.struct(*shared).alias("_ex")).join(inside, ID, "left")
    plan = a.join(b, ID, "full_outer").select(
        ID, F.coalesce("_new_top", "_old_top").alias("component"), _change(shared, include_geo).alias("change"),
        F.coalesce(F.col("_new_depth"), -F.col("_old_depth")).alias("order_rank"),
    )
    # Without a component a row exists outside the subtrees only: not ours to delete.
    return plan.where(F.col("component").isNotNull())


def apply_sync(incoming: DataFrame, existing: DataFrame, plan: DataFrame,
               spec: MergeSpec = SPECS["assets"]) -> DataFrame:
    """The existing table after the plan: replaced or added rows in, deleted rows out."""
    edits = plan.where(F.col("change").isin("new", "changed")).select(ID)
    upserts = incoming.join(edits, ID).select(*incoming.columns)
    gone = plan.where(F.col("change") == "deleted").select(ID)
    return merge(existing, upserts, spec, REPLACE).drop("_change").join(gone, ID, "left_anti")


def change_counts(plan: DataFrame) -> DataFrame:
    return plan.groupBy("change").agg(F.count(F.lit(1)).alias("n"))


def deleted_ids(assets: DataFrame, wanted: DataFrame, recursive: bool = False) -> DataFrame:
    """``(external_id)`` of the assets that a delete of ``wanted`` takes away.

    With ``recursive`` their subtrees go too; without it a child left behind is an error.
    """
    if recursive:
        stops = wanted.select(F.col(ID).alias("id")).distinct()
        below = ascend(assets, stops).reached.join(stops.select(F.col("id").alias("top")), "top")
        return below.select(F.col("id").alias(ID))
    gone = wanted.select(ID).distinct()
    stranded = assets.join(gone, ID, "left_anti").join(
        gone.select(F.col(ID).alias(PARENT)), PARENT, "left_semi").select(ID).limit(10).collect()
    if stranded:
        raise ValueError(f"children would be left behind: {[r[0] for r in stranded]}")
    return gone


def delete_assets(assets: DataFrame, wanted: DataFrame, recursive: bool = False) -> DataFrame:
    """Assets left after a delete. Without ``recursive`` a child left behind is an error."""
    return assets.join(deleted_ids(assets, wanted, recursive), ID, "left_anti").select(*assets.columns)


def upsert_assets(existing: DataFrame, incoming: DataFrame, mode: str = "update") -> DataFrame:
    """Asset upsert: ids present, unique, no self reference, no cycle; then the merge."""
    sample = violations(incoming, single_root=False).limit(10).collect()
    if sample:
        raise ValueError(f"assets are not sound: {[tuple(r) for r in sample]}")
    return merge(existing, incoming, SPECS["assets"], mode)
