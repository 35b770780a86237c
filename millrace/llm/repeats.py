"""Windows that occur more than once, found through content-chosen anchors.

Shared by the two exact substring operators. A *window* is a run of ``size`` elements (bytes or
words). Each window is owned by its smallest gram (the leftmost one on a tie), so equal windows
have equal anchors wherever they stand, and only anchors, about two for every ``size - gram``
elements, travel through the shuffle. Consecutive windows with the same anchor form a *segment*.

* An anchor that occurs once owns no repeated window.
* All segments of an anchor are equal: every window in them is repeated.
* The anchor is *branching*: its distinct segments are compared window by window, once per
  distinct segment, whatever the number of copies.

No window is left out: anchors only decide where two windows meet.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.lineage import materialize
from millrace.llm import text as tx

FACTS = "id long, t long, p int, c int, h long, s long"

_U = np.uint64
_HIGH, _LOW = _U(0xFFFFFFFF00000000), _U(0xFFFFFFFF)
_BASE = 0xBF58476D1CE4E5B9


def keyed(docs: DataFrame) -> DataFrame:
    """Documents with a row identity that also tells rows of one id with different texts apart."""
    return docs.select("doc_id", F.coalesce("doc_id", F.lit(-1)).cast("long").alias("id"),
                       F.xxhash64("text").alias("t"), "text")


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    count = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, ~_U(0), np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1: width - 1 + count])


def anchors(codes: np.ndarray, rows: np.ndarray, size: int, gram: int):
    """Segments of all rows: ``(row, start, windows, anchor hash, segment hash)``; starts count in the batch."""
    number = np.maximum(np.diff(rows) - size + 1, 0)
    empty = np.zeros(0, np.int64)
    if not number.sum():
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    prefix = tx.prefix_hash(codes, _BASE)
    grams = tx.window_hash(prefix, gram, _BASE)
    least = _sliding_min((grams & _HIGH) | np.arange(len(grams), dtype=np.uint64), size - gram + 1)
    starts = tx.ranges(rows[:-1], number)
    owner = least[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(new)
    start, windows = starts[at], np.diff(np.append(at, len(starts)))
    anchor = grams[(owner[at] & _LOW).astype(np.int64)]
    segment = tx.span_hash(prefix, start, start + windows - 1 + size, _BASE)
    return np.searchsorted(rows, start, "right") - 1, start, windows, anchor, segment


def segment_hash(codes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    return tx.span_hash(tx.prefix_hash(codes, _BASE), start, stop, _BASE)


def fact_batch(batch: pa.RecordBatch, rows: np.ndarray, found) -> pa.RecordBatch:
    """The segments of a batch as rows of ``FACTS``; positions count inside the row."""
    row, start, windows, anchor, segment = found
    return pa.RecordBatch.from_arrays([
        batch["id"].take(pa.array(row)), batch["t"].take(pa.array(row)),
        pa.array((start - rows[row]).astype(np.int32)), pa.array(windows.astype(np.int32)),
        pa.array(tx.signed(anchor)), pa.array(tx.signed(segment))], ["id", "t", "p", "c", "h", "s"])


def repeated_anchors(facts: DataFrame) -> DataFrame:
    """Segments whose anchor occurs again, with ``branching`` set where its segments differ."""
    shared = facts.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("lo"), F.max("s").alias("hi"))
    # Written first: a join of two plain scans can split a hot anchor over many tasks.
    shared = materialize(shared.where("n > 1").select("h", (F.col("lo") != F.col("hi")).alias("branching")), "shared")
    return materialize(facts.join(shared, "h"), "anchors")


def branching_classes(found: DataFrame) -> DataFrame:
    """One row per distinct branching segment: where one copy stands, and the number of copies."""
    return materialize(found.where("branching").groupBy("h", "s").agg(
        F.min(F.struct("id", "t", "p", "c")).alias("at"), F.count(F.lit(1)).alias("n")
    ).select("h", "s", "n", "at.*"), "segments")


def with_texts(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Documents that hold the chosen copy of a branching segment, with the list of those segments."""
    wanted = classes.groupBy("id", "t").agg(F.collect_list(F.struct("p", "c", "h", "s", "n")).alias("wanted"))
    return keyed(docs).drop("doc_id").join(wanted, ["id", "t"])


def document_spans(found: DataFrame, runs: DataFrame, size: int) -> DataFrame:
    """``(id, t, spans)`` from whole repeated segments and from runs ``(h, s, lo, hi)`` of repeated windows.

    Rows that repeat each other give the same spans; each is held once, so a list is bounded by one document.
    """
    whole = found.where("not branching").select(
        "id", "t", F.col("p").alias("start"), (F.col("p") + F.col("c") - 1 + size).alias("stop"))
    parts = found.where("branching").select("id", "t", "h", "s", "p").join(runs, ["h", "s"]).select(
        "id", "t", (F.col("p") + F.col("lo")).alias("start"), (F.col("p") + F.col("hi") - 1 + size).alias("stop"))
    return whole.union(parts).groupBy("id", "t").agg(F.collect_set(F.struct("start", "stop")).alias("found"))


def covered(length: int, spans: list) -> list[tuple[int, int]]:
    """Merged spans, touching ones joined, in order."""
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, min(stop, length)])
    return [tuple(x) for x in out]


def runs_of(flags: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of set flags inside each row: ``(row, lo, hi)`` counted inside the row."""
    inside = np.zeros(len(flags) + 1, bool)
    inside[:-1] = flags
    first, last = inside[:-1].copy(), inside[:-1].copy()
    first[1:] &= ~flags[:-1]
    last[:-1] &= ~flags[1:]
    heads = rows[:-1][np.diff(rows) > 0]
    tails = rows[1:][np.diff(rows) > 0] - 1
    first[heads], last[tails] = flags[heads], flags[tails]
    lo, hi = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(rows, lo, "right") - 1
    return row, lo - rows[row], hi - rows[row]


def spans_of(batch: pa.RecordBatch, at: int) -> list:
    column = batch["found"]
    value = column[at]
    return [(x["start"], x["stop"]) for x in value.as_py()] if value.is_valid else []
