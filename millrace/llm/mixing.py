"""Mixing sources to target weights by Pareto order sampling.

Every document of a source is first taken ``floor(target / size)`` whole times. The rest of the
target is a sample of unequal probabilities: a document of weight g has the inclusion probability
``p = f g sum(size) / sum(size g)``, f being the fraction left, so that the expected words are the rest. The
weight is the whole square root of the size, times that of a ``weight`` column: long documents are likelier.
Documents of ``p >= 1`` are certain and come first. With a uniform number ``u`` drawn from the document, the others
are ranked by the odds ratio ``u / (1 - u) * (1 - p) / p``, and documents are taken in that order until
the words of the source reach its target. The document at the border is taken if that comes nearer to
the target.

No source is sorted in one task: ranks are cut into ``RANK_CELLS`` cells per source whose word sums are
cumulated, the cell at the border is cut into as many again, and only documents inside that one need an order
among themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.lineage import materialize
from millrace.llm import text as tx
from millrace.llm.frames import session_of

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST = 1.5, 2.0
RANK_CELLS = 4096

_UNIT = 2.0**48
_LAST = 1 - 2.0**-53


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in tx.pieces(batches, "text"):
        words = tx.Words(*tx.utf8(batch["text"]), tx.NOT_SPACE)
        yield pa.RecordBatch.from_arrays(
            [*(batch[c] for c in ("doc_id", "source", "weight", "key")), pa.array(words.counts)], ["doc_id", "source", "weight", "key", "size"])


def uniform(key: Column) -> Column:
    """A uniform number in (0, 1) that depends on the key alone: 48 bits of its MD5."""
    return (F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 12), 16, 10).cast("double") + 0.5) / F.lit(_UNIT)


def targets(sizes: DataFrame, *, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source, source_size, target`` for ``sizes (source, source_size)``, one row per source.

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share`` of all words.
    A target stops at ``most`` times its source; the excess is shared again by weight. That has a closed
    form: in the order of size per weight, sources are full up to a point, and from there on what is
    left is shared by weight. The table has one row per source, so its windows run in one task.
    """
    order = Window.orderBy(F.col("source").isNull().cast("int"), F.col("source").cast("binary"))
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weighed = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")))
    every = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").isNull().cast("int"), F.col("source").cast("binary"))
    total, before = Window.partitionBy(), every.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.lit(share) * F.sum("source_size").over(total) - F.lit(most) * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / (
        F.sum("w").over(total) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    # The first source that is not full at the level of its turn sets the level of all after it.
    levelled = weighed.withColumn("level", level)
    fits = F.when(F.col("level") * F.col("w") <= F.lit(most) * F.col("source_size"), F.col("level"))
    first = F.first(fits, ignorenulls=True).over(every.rowsBetween(Window.unboundedPreceding, 0))
    return levelled.withColumn("at", first).select("source", "source_size", "w", F.coalesce(
        F.col("at") * F.col("w"), F.lit(most) * F.col("source_size")).alias("target"))


def _border(cells: DataFrame, below: Column) -> DataFrame:
    """``of, edge, below``: per source the last cell that begins at or before the rest, with the words before it."""
    along = Window.partitionBy("source").orderBy("cell")
    summed = cells.withColumn("below", below + F.sum("words").over(along) - F.col("words"))
    return materialize(summed.where("rest > 0 and below <= rest").groupBy("source").agg(
        F.max_by(F.struct("cell", "below"), "cell").alias("b")).select(
            F.col("source").alias("of"), F.col("b.cell").alias("edge"), F.col("b.below").alias("below")), "border")


def mix(docs: DataFrame, *, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST,
        weight: str | None = None) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` per row of ``docs``.

    ``size`` is the number of words (runs of non-space), 0 for a null text. ``taken`` is
    ``size * copies``, where copies is the whole part of target / source size, and one more for the
    sampled documents; it never exceeds ``most`` times the size. A source without words has target 0.
    ``weight`` names a positive column that multiplies a document's weight (null: 1). Reruns give the
    same mix. Rows that repeat an id share a random number; rows without an id draw theirs from the text. An
    empty table gives no rows.
    """
    session_of(docs)
    weighed = F.coalesce(F.col(weight).cast("double"), F.lit(1.0)) if weight else F.lit(1.0)
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce("text", F.lit("")))))
    sized = materialize(docs.select("doc_id", "source", "text", weighed.alias("weight"), key.alias("key")).mapInArrow(
        _count_words, "doc_id long, source string, weight double, key string, size long").withColumn(
            "g", F.col("weight") * F.floor(F.sqrt("size"))), "sizes")
    sums = materialize(sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("g")).alias("weighty")), "sources")
    per_source = targets(sums.select("source", "source_size"), weights=weights, share=share, most=most)
    per_source = materialize(per_source.join(sums.select(F.col("source").alias("_s"), "weighty"), F.col("source").eqNullSafe(F.col("_s"))).select(
        F.col("source").alias("of"), "source_size", "target", "weighty"), "targets")
    placed = sized.join(per_source, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    u, fraction = uniform(F.col("key")), F.col("ratio") - F.col("whole")
    p = F.when(F.col("weighty") > 0, fraction * F.col("g") * F.col("source_size") / F.col("weighty")).otherwise(0.0)
    odds = u / (1 - u) * ((1 - F.col("p")) / F.col("p"))
    # Mapped to [0, 1): certain documents first, those that cannot be drawn (no words) last.
    rank = F.when(F.col("p") >= 1, F.lit(0.0)).when(F.col("p") > 0, F.least(odds / (1 + odds), F.lit(_LAST))).otherwise(F.lit(_LAST))
    ranked = placed.withColumn("ratio", ratio).withColumn("whole", F.floor("ratio").cast("double")).withColumn(
        "rest", F.round(fraction * F.col("source_size"), 6)).withColumn("p", p).withColumn("rank", rank)
    ranked = ranked.withColumn("coarse", F.floor(F.col("rank") * RANK_CELLS).cast("int")).withColumn(
        "fine", F.floor((F.col("rank") * RANK_CELLS - F.col("coarse")) * RANK_CELLS).cast("int"))

    cells = ranked.groupBy("source", F.col("coarse").alias("cell")).agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    first = _border(cells, F.lit(0)).withColumnRenamed("edge", "coarse_edge").withColumnRenamed("below", "first_below")
    near = ranked.join(first, F.col("source").eqNullSafe(F.col("of")) & (F.col("coarse") == F.col("coarse_edge")))
    cells = near.groupBy("source", F.col("fine").alias("cell")).agg(
        F.sum("size").alias("words"), F.first("rest").alias("rest"), F.first("first_below").alias("first_below"))
    second = _border(cells, F.col("first_below")).withColumnRenamed("edge", "fine_edge")
    edges = materialize(first.join(second.withColumnRenamed("of", "_of"), F.col("of").eqNullSafe(F.col("_of"))).select(
        "of", "coarse_edge", "fine_edge", "below"), "edges")
    joined = ranked.join(edges, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    place, edge = F.struct("coarse", "fine"), F.struct(F.col("coarse_edge").alias("coarse"), F.col("fine_edge").alias("fine"))
    inner = Window.partitionBy("source").orderBy("rank", "doc_id", "size")
    at_edge = joined.where(place == edge).withColumn(
        "run", F.col("below") + F.coalesce(F.sum("size").over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    at_edge = at_edge.withColumn("extra", ((F.col("run") < F.col("rest")) & (2 * F.col("run") + F.col("size") <= 2 * F.col("rest"))).cast("int")).drop("run")
    away = joined.where(F.col("coarse_edge").isNull() | (place != edge)).withColumn("extra", F.coalesce((place < edge).cast("int"), F.lit(0)))
    copies = (F.col("whole") + F.when(F.col("size") > 0, F.col("extra")).otherwise(0)).cast("long")
    return away.unionByName(at_edge).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))
