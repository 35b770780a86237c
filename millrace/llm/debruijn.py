"""Removal of long repeated word runs with a compacted de Bruijn graph.

Edges are token k-mers with k = ``size``; their ends are the (k-1)-mers between them. An edge that
occurs twice is a repeated window. Anchors (see ``repeats``) stand for nonbranching stretches: where
all copies of an anchor's segment are equal, its edges form one path and never become rows. Only the
segments around branches are spelled out. Their edges are counted by aggregation (partial sums where
they are read, so a hot passage does not gather anywhere), joined back to their occurrences, and
compacted: a path ends where the copies enter or leave differently, or where the number of copies
changes. The source coordinates of each path then give the words to remove.

An edge is identified by its anchor and two independent 64 bit hashes of its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.lineage import materialize
from millrace.llm import repeats, text as tx
from millrace.llm.frames import session_of

GRAM = 8


def _words(batch: pa.RecordBatch) -> tx.Words:
    return tx.Words(*tx.utf8(batch["text"]), tx.NOT_SPACE)


def _facts(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.pieces(batches, "text"):
            words = _words(batch)
            yield repeats.fact_batch(batch, words.rows, repeats.anchors(words.hashes(), words.rows, size, GRAM))

    return run


def _edges(size: int):
    """Documents with wanted segments to edges ``(h, s, n, off, e, e2, left, right)``."""
    names = ["h", "s", "n", "off", "e", "e2", "left", "right"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.pieces(batches, "text"):
            words = _words(batch)
            hashes = words.hashes()
            wanted = batch["wanted"]
            row = np.repeat(np.arange(batch.num_rows), np.asarray(wanted.value_lengths()))
            flat = wanted.flatten()
            p, c, h, s, n = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("p", "c", "h", "s", "n"))
            start = words.rows[row] + p
            stop = start + c - 1 + size
            fits = stop <= words.rows[row + 1]
            row, p, c, h, s, n, start, stop = (x[fits] for x in (row, p, c, h, s, n, start, stop))
            same = tx.signed(repeats.segment_hash(hashes, start, stop)) == s
            c, h, s, n, start = (x[same] for x in (c, h, s, n, start))
            at = tx.ranges(start, c)
            first, second = tx.sequence_prefix(hashes), tx.second_prefix(hashes)
            e = tx.signed(tx.sequence_hash(first, at, at + size))
            e2 = tx.signed(tx.second_hash(second, at, at + size))
            off = tx.ranges(np.zeros(len(c), np.int64), c)
            # The words before and after an edge tell its neighbours; 0 beyond the segment.
            inner = off > 0
            left = np.where(inner, tx.signed(hashes)[np.maximum(at - 1, 0)], 0)
            more = off < np.repeat(c, c) - 1
            right = np.where(more, tx.signed(hashes)[np.minimum(at + size, max(len(hashes) - 1, 0))], 0) if len(at) else off
            rep = lambda x: np.repeat(x, c)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (rep(h), rep(s), rep(n), off.astype(np.int32), e, e2, left, right)], names)

    return run


def compact(edges: DataFrame) -> DataFrame:
    """Nonbranching paths of repeated edges: ``(h, s, lo, hi, copies)``, offsets inside the segment.

    An edge starts a path where the edge before it in the segment is not repeated, has another number
    of copies, or where its copies come from different words (the node before it branches).
    """
    known = lambda c: F.when(F.col(c) != 0, F.col(c))
    stats = edges.groupBy("h", "e", "e2").agg(
        F.sum("n").alias("copies"),
        (F.min(known("left")) != F.max(known("left"))).alias("joins"),
        (F.min(known("right")) != F.max(known("right"))).alias("parts")).where("copies > 1")
    kept = edges.select("h", "s", "off", "e", "e2").join(materialize(stats, "stats"), ["h", "e", "e2"])
    order = Window.partitionBy("h", "s").orderBy("off")
    before = lambda c: F.lag(c).over(order)
    starts = (before("off").isNull() | (before("off") != F.col("off") - 1) | (before("copies") != F.col("copies"))
              | F.coalesce("joins", F.lit(False)) | F.coalesce(before("parts"), F.lit(False)))
    numbered = kept.withColumn("starts", starts.cast("int")).withColumn("path", F.sum("starts").over(order))
    return numbered.groupBy("h", "s", "path").agg(
        F.min("off").alias("lo"), (F.max("off") + 1).alias("hi"), F.first("copies").alias("copies")).drop("path")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    for batch in tx.pieces(batches, "text"):
        data, offsets = tx.utf8(batch["text"])
        words = tx.Words(data, offsets, tx.NOT_SPACE)
        blob = data.tobytes()
        counts, kept, removed = words.counts, [], []
        for at in range(batch.num_rows):
            low, high = words.rows[at], words.rows[at + 1]
            spans = repeats.covered(int(high - low), repeats.spans_of(batch, at))
            stay = np.ones(high - low, bool)
            for start, stop in spans:
                stay[start:stop] = False
            index = low + np.flatnonzero(stay)
            kept.append(b" ".join(blob[a:b] for a, b in zip(words.start[index].tolist(), words.stop[index].tolist())))
            removed.append([{"start": a, "stop": b} for a, b in spans])
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(counts), pa.array(removed, kinds), pa.array([k.decode("utf-8", "replace") for k in kept])],
            ["doc_id", "n_words", "removed", "kept"])


def paths_and_spans(docs: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Compacted paths around branches, and the repeated word spans of each document."""
    facts = materialize(repeats.keyed(docs).drop("doc_id").mapInArrow(_facts(size), repeats.FACTS), "grams")
    found = repeats.repeated_anchors(facts)
    classes = repeats.branching_classes(found)
    edges = materialize(repeats.with_texts(docs, classes).mapInArrow(
        _edges(size), "h long, s long, n long, off int, e long, e2 long, left long, right long"), "edges")
    paths = materialize(compact(edges), "paths")
    return paths, repeats.document_spans(found, paths.select("h", "s", "lo", "hi"), size)


def remove_repeats(docs: DataFrame, *, size: int = 35) -> DataFrame:
    """``doc_id, n_words, removed (array of word spans), kept (text)`` per row of ``docs``.

    Words are runs of non-space bytes, unchanged. A word is removed where it is covered by a window of
    ``size`` words that also starts anywhere else, in this or another document; every copy goes.
    Kept words are joined by one space. A null text has no words. Rows with a null id, repeated ids and
    repeated rows each give a row; a repeated row counts as a copy. Other columns are not read. An
    empty table gives no rows.
    """
    session_of(docs)
    _, spans = paths_and_spans(docs, size)
    return repeats.keyed(docs).join(spans, ["id", "t"], "left").select("doc_id", "text", "found").mapInArrow(
        _cut, "doc_id long, n_words long, removed array<struct<start:long,stop:long>>, kept string")
