"""Near-duplicate classes by fast similarity sketching, banding and exact verification.

Sketches follow the fast similarity sketching scheme: in each of the first ``SIZE`` rounds every
element is thrown into one random bin, in the following ``SIZE`` rounds bin i takes all elements,
and a set stops after the round that has filled its last bin. A bin keeps the smallest value, and
values of earlier rounds are smaller. Every coordinate is filled, whatever the size of the set.

The plan, over all rows:

1. Documents with the same shingle set form a class (partial aggregation, so a hot set is counted
   where it is read). Everything below works on one representative per class.
2. Bands of the sketch point each representative to the smallest one of its bucket. The connected
   components of these pointers are the candidate groups; no pair inside a bucket is emitted.
3. Candidate groups are verified on full shingle sets. A group of more than ``CHUNK_SHINGLES`` is
   cut into chunks, and each pair of chunks is one bounded unit of work, so nothing is capped.
4. Verified links go through connected components again and back to all documents.

With ``BANDS`` bands of ``ROWS`` values a pair of similarity 0.85 is missed with a chance of about
5e-11, one of 0.80 with about 5e-8. Links are confirmed in integers: 100 * |A and B| >= percent * |A or B|.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.lineage import materialize
from millrace.llm import text as tx
from millrace.llm.frames import components, session_of

SIZE, BANDS, ROWS = 128, 32, 4
CHUNK_SHINGLES = 1_000_000

_U = np.uint64


def shingle_sets(words: tx.Words, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes per row, joined, and the row ranges."""
    prefix = tx.sequence_prefix(words.hashes())
    counts = words.counts
    number = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    start = tx.ranges(words.rows[:-1], number)
    stop = start + np.repeat(np.minimum(counts, shingle), number)
    hashes = tx.sequence_hash(prefix, start, stop)
    rows = np.concatenate([[0], np.cumsum(number)])
    sets = [np.unique(hashes[a:b]) for a, b in zip(rows[:-1], rows[1:])]
    sizes = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else hashes), np.concatenate([[0], np.cumsum(sizes)])


def sketch(elements: np.ndarray, rows: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Fast similarity sketches, one row of ``size`` values per set; empty sets keep the maximum."""
    count = len(rows) - 1
    top = ~_U(0)
    out = np.full(count * size, top, np.uint64)
    owner = tx.row_of(rows)
    active = np.diff(rows) > 0
    values, owners = elements, owner
    for turn in range(2 * size):
        if not len(values):
            break
        drawn = tx.mix(values ^ tx.mix(np.full(1, turn + 1, np.uint64)))
        if turn < size:
            spot = ((drawn >> _U(40)) % _U(size)).astype(np.int64)
        else:
            spot = np.full(len(values), turn - size, np.int64)
        value = (_U(turn) << _U(56)) | (tx.mix(drawn) >> _U(8))
        np.minimum.at(out, owners * size + spot, value)
        open_rows = active & (out.reshape(count, size) == top).any(axis=1)
        if not open_rows.all():
            keep = open_rows[owners]
            values, owners = values[keep], owners[keep]
        active = open_rows
    return out.reshape(count, size)


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """One 64 bit key per row and band."""
    parts = sketches.reshape(len(sketches), BANDS, ROWS)
    key = np.broadcast_to(tx.mix(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(sketches), BANDS)).copy()
    for i in range(ROWS):
        key = tx.mix(key ^ parts[:, :, i]) * _U(0x9E3779B97F4A7C15)
    return key


def set_keys(elements: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64 bit keys of each set."""
    keys = []
    for seed in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179):
        sums = np.concatenate([[_U(0)], np.cumsum(tx.mix(elements ^ _U(seed)), dtype=np.uint64)])
        keys.append(tx.mix(sums[rows[1:]] - sums[rows[:-1]] + np.diff(rows).astype(np.uint64)))
    return keys[0], keys[1]


def _sets_of(batch: pa.RecordBatch, column: str, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = tx.utf8(batch[column])
    return shingle_sets(tx.Words(tx.lower_ascii(data), offsets, tx.NOT_SPACE), shingle)


def _facts(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.pieces(batches, "text"):
            elements, rows = _sets_of(batch, "text", shingle)
            keys = band_keys(sketch(elements, rows))
            k1, k2 = set_keys(elements, rows)
            sizes = np.diff(rows)
            filled = sizes > 0
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"], batch["t"], pa.array(sizes), pa.array(tx.signed(k1)), pa.array(tx.signed(k2)),
                tx.lists(tx.signed(keys[filled].ravel()), np.where(filled, BANDS, 0)),
            ], ["doc_id", "t", "n_shingles", "k1", "k2", "bands"])

    return run


def linked_groups(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the index of a set of its linked component (exact; works through an inverted list).

    Searches breadth first among sets not reached yet, and drops the reached ones from the lists
    as they get fewer, so a large group of near copies costs little more than its size.
    """
    count = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    group = np.full(count, -1, np.int64)
    owner = np.repeat(np.arange(count), sizes)
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    left = count
    listed = count
    for seed in range(count):
        if group[seed] >= 0:
            continue
        group[seed] = seed
        left -= 1
        queue = [seed]
        while queue and left:
            at = queue.pop()
            low, high = np.searchsorted(values, sets[at], "left"), np.searchsorted(values, sets[at], "right")
            shared = np.bincount(owner[tx.ranges(low, high - low)], minlength=count)
            found = np.flatnonzero((100 * shared >= percent * (sizes[at] + sizes - shared)) & (group < 0) & (shared > 0))
            if len(found):
                group[found] = seed
                left -= len(found)
                queue.extend(found.tolist())
            if left < listed // 2:
                keep = group[owner] < 0
                values, owner, listed = values[keep], owner[keep], left
    return group


def _verify(shingle: int, percent: int):
    """Sorted rows of (cluster, i, j, node, k1, k2, text) to links ``(a, b)`` inside each unit."""

    def links(nodes, sets) -> tuple[list, list]:
        if len(nodes) < 2:
            return [], []
        order = np.argsort(np.array(nodes, np.int64), kind="stable")
        nodes, sets = [nodes[i] for i in order], [sets[i] for i in order]
        group = linked_groups(sets, percent)
        return [n for n, g, i in zip(nodes, group, range(len(nodes))) if g != i], [
            nodes[g] for g, i in zip(group, range(len(nodes))) if g != i]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, nodes, sets, seen = None, [], [], set()
        out_a, out_b = [], []
        for batch in tx.pieces(batches, "text"):
            elements, rows = _sets_of(batch, "text", shingle)
            key = [k.view(np.int64).tolist() for k in set_keys(elements, rows)]
            columns = [batch[c].to_pylist() for c in ("cluster", "i", "j", "node", "k1", "k2")]
            for at, (cluster, i, j, node, k1, k2) in enumerate(zip(*columns)):
                if (cluster, i, j) != unit:
                    a, b = links(nodes, sets)
                    out_a += a
                    out_b += b
                    unit, nodes, sets, seen = (cluster, i, j), [], [], set()
                # Another row may carry the same id with another text.
                if (key[0][at], key[1][at]) == (k1, k2) and (node, k1) not in seen:
                    seen.add((node, k1))
                    nodes.append(node)
                    sets.append(elements[rows[at]: rows[at + 1]].copy())
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])
            out_a, out_b = [], []
        a, b = links(nodes, sets)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _sketched(docs: DataFrame, shingle: int) -> DataFrame:
    return materialize(docs.select("doc_id", F.xxhash64("text").alias("t"), "text").mapInArrow(
        _facts(shingle), "doc_id long, t long, n_shingles long, k1 long, k2 long, bands array<long>"), "sketches")


def _classes(facts: DataFrame) -> DataFrame:
    """One row per distinct set, with its first row ``at (doc_id, t)``; rows with a null id or an empty set are left out."""
    return facts.where("doc_id is not null and n_shingles > 0").groupBy("k1", "k2").agg(
        F.min(F.struct("doc_id", "t")).alias("at"), F.first("n_shingles").alias("size"), F.first("bands").alias("bands"))


def _linked(docs: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``(node, component)`` of the classes that link with another one."""
    entries = classes.select("node", F.explode("bands").alias("key"))
    buckets = entries.groupBy("key").agg(F.min("node").alias("b"), F.max("node").alias("top")).where("b < top")
    # Small tables are written before they meet a large side: a join of two plain scans can split a hot key.
    pointers = entries.join(materialize(buckets.select("key", "b"), "buckets"), "key").select(F.col("node").alias("a"), "b")
    # Two classes of one id (a repeated id) are one node; their texts are verified apart.
    cluster_of = components(pointers)

    members = classes.select("node", "at", "k1", "k2", "size").join(
        cluster_of.withColumnRenamed("component", "cluster"), "node")
    load = members.groupBy("cluster").agg(F.ceil(F.sum("size") / CHUNK_SHINGLES).alias("chunks"))
    placed = members.join(load, "cluster").select(
        "at.doc_id", "at.t", "node", "k1", "k2", "cluster", "chunks",
        F.pmod(F.xxhash64("node"), F.col("chunks")).alias("chunk"))
    unit = F.transform(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1), lambda o: F.struct(
        F.least("chunk", o).alias("i"), F.greatest("chunk", o).alias("j")))
    texts = docs.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("t"), "text").join(placed, ["doc_id", "t"])
    units = texts.select("cluster", F.explode(unit).alias("u"), "node", "k1", "k2", "text").select(
        "cluster", "u.i", "u.j", "node", "k1", "k2", "text")
    links = (units.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
             .mapInArrow(_verify(shingle, percent), "a long, b long"))
    return components(links)


def near_duplicates(docs: DataFrame, *, shingle: int = 5, percent: int = 85) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept, text_hash``.

    ``docs`` needs ``doc_id`` (long) and ``text``; other columns are not read. Texts are lower-cased
    in A-Z and cut at white space; the set of a text holds its distinct runs of ``shingle`` words, or
    the whole sequence where it has fewer. Null and blank texts have an empty set and link with
    nothing. Rows with a null id get a null component and ``kept`` null. Rows that repeat an id each
    give a row; sets with the same smallest id are one node, so they are in one component. An empty table gives no rows.
    """
    session_of(docs)
    facts = _sketched(docs, shingle)
    classes = materialize(_classes(facts).withColumn("node", F.col("at.doc_id")), "classes")
    component_of = _linked(docs, classes, shingle, percent)

    found = classes.join(component_of, "node", "left").select(
        "k1", "k2", F.coalesce("component", "node").alias("component"))
    out = facts.drop("bands").join(materialize(found, "found"), ["k1", "k2"], "left")
    filled = F.col("n_shingles") > 0
    component = F.when(F.col("doc_id").isNotNull(), F.when(filled, F.col("component")).otherwise(F.col("doc_id")))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      (F.col("doc_id") == component).alias("kept"), F.col("t").alias("text_hash"))


def one_per_group(docs: DataFrame, *, shingle: int = 5, percent: int = 80, by_text: bool = False) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one for each component.

    Rows with a null id link with nothing and stay. Of rows that repeat the id of a component one stays, with
    the text of the least hash. With ``by_text`` an id ties no texts together: components are over distinct
    shingle sets, the row with the least id (then text hash) of each stays, and null and blank texts all stay.
    """
    if not by_text:
        kept = near_duplicates(docs, shingle=shingle, percent=percent).where("kept").groupBy("doc_id").agg(
            F.min("text_hash").alias("_kept_hash")).withColumnRenamed("doc_id", "_kept_id")
        named = docs.where("doc_id is not null")
        same = (named["doc_id"] == kept["_kept_id"]) & (F.xxhash64(named["text"]) == kept["_kept_hash"])
        chosen = named.join(kept, same, "left_semi").dropDuplicates(["doc_id"])
        return chosen.unionByName(docs.where("doc_id is null"))
    session_of(docs)
    # Written with their numbers, which must not change between the joins.
    classes = materialize(_classes(_sketched(docs, shingle)).withColumn("node", F.monotonically_increasing_id()), "classes")
    component_of = _linked(docs, classes, shingle, percent)
    kept = classes.join(component_of, "node", "left").groupBy(F.coalesce("component", "node").alias("component")).agg(
        F.min("at").alias("at")).select(F.col("at.doc_id").alias("_kept_id"), F.col("at.t").alias("_kept_hash"))
    alone = F.col("doc_id").isNull() | ~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    named = docs.where(~alone).withColumn("_hash", F.xxhash64("text"))
    same = (named["doc_id"] == kept["_kept_id"]) & (named["_hash"] == kept["_kept_hash"])
    chosen = named.join(kept, same, "left_semi").dropDuplicates(["doc_id", "_hash"]).drop("_hash")
    return chosen.unionByName(docs.where(alone))
