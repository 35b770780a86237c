"""Weak and strong components of edge lists, in rounds of equi joins.

Edges are ``(a, b)`` of one type that can be ordered. Every round is written to the shared folder, so
lineage stays one round deep. Hot nodes are skewed join keys, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from millrace.lineage import materialize, materialize_counted


def _watched(df: DataFrame, *columns: str) -> tuple[DataFrame, tuple]:
    """``df`` written, with its row count and a digest of its rows."""
    seen = Observation()
    digest = F.sum(F.xxhash64(*columns).cast("decimal(38, 0)"))
    out = materialize(df.observe(seen, F.count(F.lit(1)).alias("n"), digest.alias("digest")), "component")
    return out, (seen.get["n"], seen.get["digest"])


def weak_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` with the least node that edges connect, whatever their direction.

    Large and small stars in turn: every node hangs its larger neighbours, then its smaller ones, under the
    least of them, until the edges are stars. Nodes without an edge to another do not occur.
    """
    current, state = _watched(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "a", "b")
    before = None
    while state != before and state[0]:
        before = state
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.min("b").alias("_b")).select("a", F.least("a", "_b").alias("m")), "least")
        large = materialize(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        stars = large.join(small, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        current, state = _watched(stars.union(small.select("a", F.col("m").alias("b"))).distinct(), "a", "b")
    star = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return star.union(star.select(F.col("component").alias("node"), "component").distinct())


def _trimmed(edges: DataFrame, count: int) -> tuple[DataFrame, int]:
    """Edges left after nodes without an edge in, or without one out, are taken away again and again."""
    while count:
        into = edges.select(F.col("b").alias("a")).distinct()
        out = edges.select(F.col("a").alias("b")).distinct()
        edges, left = materialize_counted(edges.join(into, "a", "left_semi").join(out, "b", "left_semi").select("a", "b"), F.lit(True), "trim")
        if left == count:
            break
        count = left
    return edges, count


def strong_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of all nodes on cycles; nodes of one component reach each other along edges.

    Trimming leaves cycles and what lies between them. Each node then takes the greatest node that reaches it as
    its colour; of one colour, the nodes from which the node of that name is reached back are its
    component. Components and edges between colours go, and the rest is trimmed again. An edge from a
    node to itself is a cycle. Components are named by their greatest node.
    """
    current, count = materialize_counted(edges.select("a", "b").distinct(), F.lit(True), "strong")
    own = materialize(current.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("component")), "own")
    current, count = materialize_counted(current.where("a <> b"), F.lit(True), "strong")
    found = []
    while True:
        current, count = _trimmed(current, count)
        if not count:
            break
        nodes = current.select(F.col("a").alias("node")).distinct()
        colour, state = _watched(nodes.select("node", F.col("node").alias("colour")), "node", "colour")
        before = None
        while state != before:
            before = state
            reached = current.join(colour, F.col("a") == F.col("node")).select(F.col("b").alias("node"), "colour")
            colour, state = _watched(colour.union(reached).groupBy("node").agg(F.max("colour").alias("colour")), "node", "colour")
        ends = colour.select(F.col("node").alias("b"), F.col("colour").alias("_cb"))
        within, count = materialize_counted(
            current.join(colour.select(F.col("node").alias("a"), "colour"), "a").join(ends, "b").where("colour = _cb").select("a", "b", "colour"),
            F.lit(True), "within")
        back, state = _watched(colour.where("node = colour"), "node", "colour")
        before = None
        while state != before:
            before = state
            sources = within.join(back.select(F.col("node").alias("b"), F.col("colour")), ["b", "colour"]).select(F.col("a").alias("node"), "colour")
            back, state = _watched(back.union(sources).distinct(), "node", "colour")
        # A colour's own node without a way back to itself is no cycle.
        sizes = back.groupBy("colour").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("colour")
        found.append(materialize(back.join(sizes, "colour", "left_semi").select("node", F.col("colour").alias("component")), "strong"))
        gone = back.select(F.col("node").alias("a"))
        current, count = materialize_counted(
            within.select("a", "b").join(gone, "a", "left_anti").join(gone.withColumnRenamed("a", "b"), "b", "left_anti").select("a", "b"),
            F.lit(True), "strong")
    whole = own.limit(0)
    for part in found:
        whole = whole.union(part)
    return whole.union(own.join(whole.select("node"), "node", "left_anti").select("node", "component"))
