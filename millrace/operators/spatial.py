"""3D nodes and mappings: subtree and ancestor containment, box joins.

Nodes carry ``(model_id, revision_id, node_id, tree_index, subtree_size, depth)``.
Both joins below are plain equi joins: intervals are cut into aligned blocks and
boxes into grid cells, so nothing runs as a nested loop.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from millrace.lineage import materialize

REVISION = ("model_id", "revision_id")
_BITS = 5            # block sizes are powers of 32
_LEVELS = 9          # up to 2**45 nodes per revision


def _on_level(numbers: Column, level: int) -> Column:
    return F.transform(numbers, lambda b: F.struct(F.lit(level).alias("level"), b.alias("block")))


def _blocks(lo: Column, hi: Column) -> Column:
    """Aligned blocks ``struct<level, block>`` that exactly tile ``[lo, hi)``.

    Per level: the blocks that fit in the interval but whose parent block does not.
    """
    none = F.array().cast("array<struct<level:int,block:bigint>>")
    tiles = []
    for level in range(_LEVELS):
        size, up = 1 << (_BITS * level), 1 << (_BITS * (level + 1))
        ceil = lambda x, s: F.floor((x + F.lit(s - 1)) / F.lit(s)).cast("long")
        floor = lambda x, s: F.floor(x / F.lit(s)).cast("long")
        first, last = ceil(lo, size), floor(hi, size) - 1
        outer_first, outer_last = ceil(lo, up), floor(hi, up) - 1
        fan = F.lit(1 << _BITS)
        span = lambda a, b: F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<bigint>"))
        if level == _LEVELS - 1:
            numbers = span(first, last)
        else:
            whole = outer_first <= outer_last
            numbers = F.when(
                whole,
                F.concat(span(first, outer_first * fan - 1), span((outer_last + 1) * fan, last)),
            ).otherwise(span(first, last))
        tiles.append(_on_level(numbers, level))
    return F.when(lo < hi, F.concat(*tiles)).otherwise(none)


def _enclosing(index: Column, levels: list[int]) -> Column:
    """The block holding ``index`` on each of the levels."""
    return F.array(*[
        F.struct(F.lit(n).alias("level"), F.shiftright(index, _BITS * n).cast("long").alias("block"))
        for n in levels
    ])


def _tiles(nodes: DataFrame, *columns) -> DataFrame:
    """The blocks that tile each node's subtree."""
    span = _blocks(F.col("tree_index"), F.col("tree_index") + F.col("subtree_size"))
    return nodes.select(*REVISION, *columns, F.explode(span).alias("_b")).select(
        "*", F.col("_b.level").alias("_level"), F.col("_b.block").alias("_block")).drop("_b")


def _points(nodes: DataFrame, tiles: DataFrame, *columns) -> DataFrame:
    """The block of each node on the levels that occur among the tiles (nine at most)."""
    levels = sorted(r[0] for r in tiles.select("_level").distinct().collect())
    spread = F.explode(_enclosing(F.col("tree_index"), levels) if levels else F.array().cast("array<struct<level:int,block:bigint>>"))
    return nodes.select(*REVISION, *columns, spread.alias("_b")).select(
        "*", F.col("_b.level").alias("_level"), F.col("_b.block").alias("_block")).drop("_b")


def subtree_nodes(nodes: DataFrame, roots: DataFrame, depth: int | None = None) -> DataFrame:
    """Nodes under each root, the root included, at most ``depth`` levels down.

    ``roots`` is ``(model_id, revision_id, node_id)``. The result is the node columns
    plus ``root_node_id``; a node under two requested roots comes once for each.
    """
    picked = nodes.join(roots.select(*REVISION, "node_id").distinct(), [*REVISION, "node_id"])
    tiles = _tiles(picked, F.col("node_id").alias("root_node_id"), F.col("depth").alias("_root_depth"))
    # Keys are matched first, on the few levels of the roots' blocks; whole rows join once.
    found = _points(nodes, tiles, "node_id", F.col("depth").alias("_depth")).join(tiles, [*REVISION, "_level", "_block"])
    if depth is not None:
        found = found.where(F.col("_depth") - F.col("_root_depth") <= F.lit(depth))
    pairs = found.select(*REVISION, "node_id", "root_node_id")
    return nodes.join(pairs, [*REVISION, "node_id"]).select(*nodes.columns, "root_node_id")


def ancestor_nodes(nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """Ancestors of each wanted node, the node included; node columns plus ``of_node_id``."""
    picked = nodes.join(wanted.select(*REVISION, "node_id").distinct(), [*REVISION, "node_id"])
    tiles = _tiles(nodes, "node_id")
    probes = _points(picked, tiles, F.col("node_id").alias("of_node_id"))
    pairs = tiles.join(probes, [*REVISION, "_level", "_block"]).select(*REVISION, "node_id", "of_node_id")
    return nodes.join(pairs, [*REVISION, "node_id"]).select(*nodes.columns, "of_node_id")


# ------------------------------------------------------------------------ boxes

def _edge(box: Column, side: str, axis: int) -> Column:
    return F.get(box[side], F.lit(axis)).cast("double")


_SPAN = 6            # cells per axis that usual boxes of both sides take up together
_HOT = 1 << 24        # candidates of one cell that stay in one task
_FAR = 1 << 62        # cell numbers beyond are one cell


def _with_edges(df: DataFrame, box: str, on: tuple[str, ...], end: str) -> DataFrame:
    """``on``, the row as ``_<end>`` and the six faces of its box; rows without a whole box go."""
    faces = {f"_{end}{side}{n}": _edge(F.col(box), side, n) for side in ("min", "max") for n in range(3)}
    kept = df.select(*on, F.struct(*df.columns).alias(f"_{end}"), *(face.alias(name) for name, face in faces.items()))
    # Few bytes can mean many cells, so the split goes by row, not by size.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(kept.dropna(subset=list(faces)).repartition(tasks), "boxes")


def _extent(end: str, axis: int) -> Column:
    return F.nanvl(F.col(f"_{end}max{axis}") - F.col(f"_{end}min{axis}"), F.lit(float("inf")))


def _usual(df: DataFrame, end: str) -> tuple[int, list[float]]:
    """Number of boxes, and per axis an extent that few of those that have any exceed."""
    sizes = [F.when(_extent(end, n) > 0, _extent(end, n)) for n in range(3)]
    n, *found = df.agg(F.count(F.lit(1)), *(F.percentile_approx(size, 0.95) for size in sizes)).first()
    # A box without end is for the levels; it may not set the grid.
    return n, [min(x or 0.0, 1e300) for x in found]


def _graded(df: DataFrame, end: str, usual: list[float], edges: list[float]) -> DataFrame:
    """Rows plus ``_<end>level``: 0 for usual boxes, else the doublings until cells are wider than the box."""
    times = F.greatest(*(_extent(end, n) / F.lit(max(usual[n], edges[n])) for n in range(3)))
    level = F.when(times <= 1, F.lit(0)).otherwise(F.least(F.ceil(F.log2(F.least(times, F.lit(1e300)))), F.lit(2200)) + 3)
    return df.withColumn(f"_{end}level", F.when(times == float("inf"), F.lit(2203)).otherwise(level).cast("int"))


def _cell(face: str, axis: int, edges: list[float], level: Column) -> Column:
    """Number of the cell a face lies in; never falls as the face rises."""
    number = F.floor(F.col(face) / (F.lit(edges[axis]) * F.pow(F.lit(2.0), level))).cast("long")
    return F.greatest(F.least(number, F.lit(_FAR)), F.lit(-_FAR))


def _spans(df: DataFrame, end: str, edges: list[float]) -> dict[int, list[int]]:
    """Per level in use, the most cells per axis between the two faces of a box."""
    level = F.col(f"_{end}level")
    span = lambda n: _cell(f"_{end}max{n}", n, edges, level) - _cell(f"_{end}min{n}", n, edges, level)
    return {r[0]: list(r[1:]) for r in df.groupBy(level).agg(*(F.max(span(n)) for n in range(3))).collect()}


def box_join(left: DataFrame, right: DataFrame, left_box: str = "bounding_box", right_box: str = "bounding_box",
             on: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of rows whose boxes overlap (touching counts), each pair once.

    The grid is set per axis by the usual extents of both sides; larger boxes use doubled cells. A pair
    meets on the grid of the larger of the two. There a box of the side of more rows is filed in the one
    cell of its low corner, and a box of the other side in all cells where the low corner of a partner can lie,
    so no pair meets twice. Cells of very many candidates are dealt over several tasks.
    """
    a, b = _with_edges(left, left_box, on, "a"), _with_edges(right, right_box, on, "b")
    (a_rows, a_usual), (b_rows, b_usual) = _usual(a, "a"), _usual(b, "b")
    edges = [2.0 ** min(math.ceil(math.log2((x + y) / _SPAN)), 1000) if x + y > 0 else 2.0 ** -20
             for x, y in zip(a_usual, b_usual)]
    a, b = _graded(a, "a", a_usual, edges), _graded(b, "b", b_usual, edges)
    once, many, one, all_ = (a, b, "a", "b") if a_rows >= b_rows else (b, a, "b", "a")
    reach = _spans(once, one, edges)
    # A handful of sizes exist: levels are exponents of two.
    levels = sorted(_spans(many, all_, edges))

    numbers = lambda found: F.array(*map(F.lit, found)).cast("array<int>")
    grid = F.greatest("_alevel", "_blevel")
    filed = once.withColumn(f"_{all_}level", F.explode(numbers(levels)))
    key = [*on, "_alevel", "_blevel", "_cell"]
    filed = filed.withColumn("_cell", F.xxhash64(*(_cell(f"_{one}min{n}", n, edges, grid) for n in range(3))))

    offered = many.withColumn(f"_{one}level", F.explode(numbers(sorted(reach))))
    own = F.col(f"_{one}level")
    axis = []
    for n in range(3):
        # On a grid doubled d times a box spans at most the 2**d-th part of its cells, rounded up.
        most = F.lit(0).cast("long")
        for level, span in reach.items():
            most = F.when(own == level, F.ceil(F.lit(span[n]) / F.pow(F.lit(2.0), grid - own)).cast("long")).otherwise(most)
        axis.append(F.sequence(_cell(f"_{all_}min{n}", n, edges, grid) - most, _cell(f"_{all_}max{n}", n, edges, grid)))
    cells = F.flatten(F.transform(axis[0], lambda x: F.flatten(
        F.transform(axis[1], lambda y: F.transform(axis[2], lambda z: F.xxhash64(x, y, z))))))
    # Cells whose hashes clash count once; the boxes themselves are compared below.
    offered = offered.withColumn("_cell", F.explode(F.array_distinct(cells)))

    held = lambda df, count: df.groupBy(*key).agg(F.count(F.lit(1)).alias(count))
    candidates = held(filed, "_na").join(held(offered, "_nb"), key)
    pieces = F.ceil(F.col("_na") * F.col("_nb").cast("double") / _HOT).cast("int")
    hot = materialize(candidates.where(pieces > 1).select(*key, F.least(pieces, F.lit(1 << 16)).alias("_pieces")), "boxes")
    if not hot.isEmpty():
        faces = [f"_{one}{side}{n}" for side in ("min", "max") for n in range(3)]
        filed = filed.withColumn("_at", F.monotonically_increasing_id()).join(hot, key, "left").withColumn(
            "_piece", F.coalesce(F.pmod(F.xxhash64("_at", *faces), F.col("_pieces")).cast("int"), F.lit(0))).drop("_at", "_pieces")
        offered = offered.join(hot, key, "left").withColumn(
            "_piece", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1))).drop("_pieces")
        key.append("_piece")
    # Few bytes can mean many pairs, so the split goes by cell, not by size, and no side is broadcast.
    tasks = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = offered.repartition(tasks, *key).hint("merge").join(filed.repartition(tasks, *key), key)
    overlap = F.lit(True)
    for n in range(3):
        overlap = overlap & (F.col(f"_amin{n}") <= F.col(f"_bmax{n}")) & (F.col(f"_amax{n}") >= F.col(f"_bmin{n}"))
    return met.where(overlap).select("_a", "_b")


def mappings_with_nodes(mappings: DataFrame, nodes: DataFrame) -> DataFrame:
    """Asset mappings with their node's columns."""
    extra = [c for c in nodes.columns if c not in mappings.columns]
    return mappings.join(nodes.select(*REVISION, "node_id", *extra), [*REVISION, "node_id"])


def create_mappings(existing: DataFrame, new: DataFrame) -> DataFrame:
    key = [*REVISION, "node_id", "asset_id"]
    added = new.dropDuplicates(key).join(existing.select(*key), key, "left_anti")
    return existing.unionByName(added.select(*existing.columns))


def delete_mappings(existing: DataFrame, gone: DataFrame) -> DataFrame:
    key = [*REVISION, "node_id", "asset_id"]
    return existing.join(gone.select(*key).distinct(), key, "left_anti")


def node_list(nodes: DataFrame, by_node_id: bool = False, limit: int | None = None) -> DataFrame:
    """Nodes by ascending tree index, or by node id."""
    ordered = nodes.orderBy("node_id" if by_node_id else "tree_index")
    return ordered if limit is None else ordered.limit(limit)
