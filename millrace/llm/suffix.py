"""Removal of repeated byte strings with two-stage suffix sorting.

Anchors (see ``repeats``) bring together the segments in which two equal windows can stand; segments
whose copies are all equal are repeated as they are. The rest, one copy of each distinct segment, is
grouped by anchor, and every task sorts the suffixes of its groups, a few megabytes at a time:

1. A suffix is of type B if it is smaller than its successor, else of type A. Only B suffixes are
   sorted directly (to the depth of a window, which is all that is asked).
2. The buckets of first bytes are scanned in ascending order; each suffix found places its
   predecessor, if that is of type A, behind the others of its bucket. This induces the whole order.
3. Windows whose common prefix with a neighbour in that order reaches ``size`` are repeated.

Only window starts, and the few bytes up to the next B suffix, take part. An anchor with more than
``GROUP_SEGMENTS`` distinct segments would fill a task: its windows are counted by an aggregation on
128 bit window hashes, with partial sums where they are read, and joined back instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.lineage import materialize
from millrace.llm import repeats, text as tx
from millrace.llm.frames import session_of

GRAM = 32
GROUP_SEGMENTS = 4096
SORT_BYTES = 3_000_000
PIECE_BYTES = 500_000

_STEP = 40


def _facts(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.pieces(batches, "text", PIECE_BYTES):
            data, offsets = tx.utf8(batch["text"])
            yield repeats.fact_batch(batch, offsets, repeats.anchors(tx.byte_codes(data), offsets, size, GRAM))

    return run


def _segments(size: int):
    """Documents with wanted segments to ``(h, s, n, c, body)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.pieces(batches, "text", PIECE_BYTES):
            data, offsets = tx.utf8(batch["text"])
            codes = tx.byte_codes(data)
            wanted = batch["wanted"]
            row = np.repeat(np.arange(batch.num_rows), np.asarray(wanted.value_lengths()))
            flat = wanted.flatten()
            p, c, h, s, n = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("p", "c", "h", "s", "n"))
            start = offsets[row] + p
            stop = start + c - 1 + size
            fits = stop <= offsets[row + 1]
            c, h, s, n, start, stop = (x[fits] for x in (c, h, s, n, start, stop))
            same = tx.signed(repeats.segment_hash(codes, start, stop)) == s
            c, h, s, n, start, stop = (x[same] for x in (c, h, s, n, start, stop))
            blob = data.tobytes()
            body = pa.array([blob[a:b] for a, b in zip(start.tolist(), stop.tolist())], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(h), pa.array(s), pa.array(n), pa.array(c.astype(np.int32)), body], ["h", "s", "n", "c", "body"])

    return run


def suffix_order(data: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The ``wanted`` positions (flags) ordered by their suffixes of ``data`` to ``depth`` bytes."""
    count = len(data)
    if not count:
        return np.zeros(0, np.int64)
    # A run of equal bytes has one type: that of its last byte against the byte behind the run.
    heads = np.flatnonzero(np.concatenate([[True], data[1:] != data[:-1]]))
    rises = np.zeros(len(heads), bool)
    rises[:-1] = data[heads[:-1]] < data[heads[1:]]
    type_b = np.repeat(rises, np.diff(np.append(heads, count)))
    # Positions that take part: the wanted ones, and on from each to the next B suffix.
    part = wanted.copy()
    at_b = np.flatnonzero(type_b)
    ends = np.flatnonzero(wanted & ~np.append(wanted[1:], False)) + 1
    next_b = np.append(at_b, count - 1)[np.searchsorted(at_b, ends - 1)]
    part[tx.ranges(ends, np.maximum(next_b + 1 - ends, 0))] = True

    blob = data.tobytes()
    direct = sorted(np.flatnonzero(part & type_b).tolist(), key=lambda i: blob[i: i + depth])
    direct = np.array(direct, np.int64)
    first = data[direct]
    b_rows = np.searchsorted(first, np.arange(257))
    placed: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced = part & ~type_b
    if induced[count - 1]:
        placed[data[count - 1]].append(np.array([count - 1]))  # behind it stands the empty suffix, the smallest
    order = []
    for byte in range(256):
        front = np.concatenate(placed[byte]) if placed[byte] else np.zeros(0, np.int64)
        found = [front]
        while len(front):
            front = front[front > 0] - 1
            front = front[induced[front] & (data[front] == byte)]
            found.append(front)
        bucket = np.concatenate([*found, direct[b_rows[byte]: b_rows[byte + 1]]])
        placed[byte] = []
        order.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[induced[before] & (data[before] > byte)]
        if len(before):
            into = data[before]
            by = np.argsort(into, kind="stable")
            before, into = before[by], into[by]
            cuts = np.flatnonzero(np.concatenate([[True], into[1:] != into[:-1]]))
            for low, high in zip(cuts, np.append(cuts[1:], len(into))):
                placed[into[low]].append(before[low:high])
    order = np.concatenate(order)
    return order[wanted[order]]


def repeated_windows(data: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Of the windows at the flagged ``starts``, those equal to another one (flags by position).

    Windows must end inside ``data``. Neighbours in suffix order are compared step by step; only
    pairs that agree so far go on.
    """
    flags = np.zeros(len(data), bool)
    order = suffix_order(data, starts, size)
    if len(order) < 2:
        return flags
    a, b = order[:-1], order[1:]
    for at in range(0, size, _STEP):
        width = min(_STEP, size - at)
        view = np.lib.stride_tricks.sliding_window_view(data, width)
        equal = (view[a + at] == view[b + at]).all(axis=1)
        a, b = a[equal], b[equal]
    flags[a] = flags[b] = True
    return flags


def _sorted_runs(size: int):
    """Segments ordered by anchor to runs ``(h, s, lo, hi)`` of repeated windows."""

    def solve(h, s, n, c, body) -> pa.RecordBatch:
        lengths = np.array([len(x) for x in body], np.int64)
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        data = np.frombuffer(b"".join(body), np.uint8)
        c = np.array(c, np.int64)
        at = tx.ranges(offsets[:-1], c)
        starts = np.zeros(len(data), bool)
        starts[at] = True
        flags = repeated_windows(data, starts, size)[at] | np.repeat(np.array(n, np.int64) > 1, c)
        row, lo, hi = repeats.runs_of(flags, np.concatenate([[0], np.cumsum(c)]))
        return pa.RecordBatch.from_arrays([
            pa.array(np.array(h, np.int64)[row]), pa.array(np.array(s, np.int64)[row]),
            pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], ["h", "s", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {k: [] for k in ("h", "s", "n", "c", "body")}
        total, seen = 0, set()
        for batch in batches:
            columns = [batch[k].to_pylist() for k in held]
            for row in zip(*columns):
                if held["h"] and row[0] != held["h"][-1]:
                    seen.clear()
                    if total >= SORT_BYTES:
                        yield solve(**held)
                        held, total = {k: [] for k in held}, 0
                if row[1] in seen:
                    continue  # the same segment, read from rows that repeat each other
                seen.add(row[1])
                for k, v in zip(held, row):
                    held[k].append(v)
                total += len(row[4])
        if held["h"]:
            yield solve(**held)

    return run


def _window_keys(size: int):
    """Segments to their windows ``(h, s, off, e, e2, n)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tx.utf8(batch["body"])
            c = batch["c"].to_numpy().astype(np.int64)
            at = tx.ranges(offsets[:-1], c)
            codes = tx.byte_codes(data)
            first, second = tx.sequence_prefix(codes), tx.second_prefix(codes)
            rep = lambda k: np.repeat(batch[k].to_numpy(), c)
            yield pa.RecordBatch.from_arrays([
                pa.array(rep("h")), pa.array(rep("s")), pa.array(tx.ranges(np.zeros(len(c), np.int64), c).astype(np.int32)),
                pa.array(tx.signed(tx.sequence_hash(first, at, at + size))),
                pa.array(tx.signed(tx.second_hash(second, at, at + size))), pa.array(rep("n"))],
                ["h", "s", "off", "e", "e2", "n"])

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    for batch in tx.pieces(batches, "text"):
        data, offsets = tx.utf8(batch["text"])
        blob = data.tobytes()
        kept, removed = [], []
        for at, (low, high) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            spans = repeats.covered(high - low, repeats.spans_of(batch, at))
            edges = [0, *(x for span in spans for x in span), high - low]
            kept.append(b"".join(blob[low + a: low + b] for a, b in zip(edges[::2], edges[1::2])))
            removed.append([{"start": a, "stop": b} for a, b in spans])
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(np.diff(offsets)), pa.array(removed, kinds), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "removed", "kept"])


def remove_repeats(docs: DataFrame, *, size: int = 200) -> DataFrame:
    """``doc_id, n_bytes, removed (array of byte spans), kept (binary)`` per row of ``docs``.

    Texts count as UTF-8 bytes, null as empty. A byte goes where it is covered by a string of ``size``
    bytes that also starts anywhere else, in this or another document, overlaps included; strings never
    cross documents and are judged on the input. Rows with a null id, repeated ids and repeated rows
    each give a row; a repeated row counts as a copy. Other columns are not read. An empty table gives
    no rows. ``kept`` may cut through a character, so it is binary.
    """
    session_of(docs)
    facts = materialize(repeats.keyed(docs).drop("doc_id").mapInArrow(_facts(size), repeats.FACTS), "grams")
    found = repeats.repeated_anchors(facts)
    classes = repeats.branching_classes(found)
    crowded = materialize(classes.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > GROUP_SEGMENTS).select("h"), "crowded")
    bodies = materialize(repeats.with_texts(docs, classes).mapInArrow(
        _segments(size), "h long, s long, n long, c int, body binary"), "bodies")

    grouped = bodies.join(crowded, "h", "left_anti").repartition("h").sortWithinPartitions("h")
    runs = grouped.mapInArrow(_sorted_runs(size), "h long, s long, lo int, hi int")
    windows = bodies.join(crowded, "h", "left_semi").mapInArrow(
        _window_keys(size), "h long, s long, off int, e long, e2 long, n long")
    again = materialize(windows.groupBy("h", "e", "e2").agg(F.sum("n").alias("copies")).where("copies > 1").drop("copies"), "again")
    spread = windows.join(again, ["h", "e", "e2"]).select("h", "s", F.col("off").alias("lo"), (F.col("off") + 1).alias("hi"))
    spans = repeats.document_spans(found, materialize(runs.union(spread), "runs"), size)
    return repeats.keyed(docs).join(spans, ["id", "t"], "left").select("doc_id", "text", "found").mapInArrow(
        _cut, "doc_id long, n_bytes long, removed array<struct<start:long,stop:long>>, kept binary")
