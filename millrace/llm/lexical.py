"""Ranked lexical search over a length-stratified index.

A document of n terms has the normaliser ``m = 25 + 75 n N div L``: all documents of one m form a stratum, in
which the weight of a term depends on its frequency alone. The index keeps one row per document, its term hashes
and frequencies, ordered by n within each file, so strata are contiguous; it knows nothing of queries.

A search task reads a run of documents, keeps the postings of terms that items ask for, and orders them by
term, stratum and falling frequency. Each (term, stratum, frequency) has its impact computed once. The first
frequency of a term in a stratum is its highest, so the sum of those impacts bounds all scores in the stratum.
For every item strata are visited from the highest bound down, until bounds fall below the k-th score found;
bounds equal to it are visited too, since ties go to smaller ids. Results are exact.

Documents are not shuffled, only the k best of each task and item are. Items come in blocks of
``BLOCK_TERMS`` distinct (item, term) pairs in expectation; each block is a pass over the index, and the driver
holds one block at a time. Terms are compared by 64 bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window, functions as F

from millrace.lineage import materialize
from millrace.llm import text as tx
from millrace.llm.frames import session_of

# The scoring formula.
BASE, SLOPE = 25, 75
UNIT, TF_FACTOR, M_FACTOR = 1_000_000_000, 1000, 8

BLOCK_TERMS = 200_000
RUN_POSTINGS = 4_000_000


def _terms(key: str):
    """``(key, text)`` to ``(key, n, terms, tfs)`` of the rows that hold a term; terms are sorted hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.pieces(batches, "text"):
            data, offsets = tx.utf8(batch["text"])
            words = tx.Words(tx.lower_ascii(data), offsets, tx.ALNUM)
            hashes, row = tx.signed(words.hashes()), tx.row_of(words.rows)
            order = np.lexsort((hashes, row))
            h, r = hashes[order], row[order]
            head = np.ones(len(h), bool)
            head[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
            at = np.flatnonzero(head)
            tf = np.diff(np.append(at, len(h)))
            distinct = np.bincount(r[at], minlength=batch.num_rows)
            found = pa.RecordBatch.from_arrays(
                [batch[key], pa.array(words.counts), tx.lists(pa.array(h[at]), distinct), tx.lists(pa.array(tf.astype(np.int32)), distinct)],
                [key, "n", "terms", "tfs"])
            yield found.filter(pa.array(words.counts > 0))

    return run


@dataclass
class Index:
    """One row ``(doc_id, n, terms, tfs)`` per document with a term; their number and all their terms with repeats."""

    rows: DataFrame
    documents: int
    length: int

    def normalised(self) -> DataFrame:
        """The rows with m in place of n; the product may exceed a long."""
        m = F.expr(f"cast({BASE} + cast({SLOPE}L * n as decimal(38, 0)) * {self.documents} div {max(self.length, 1)} as bigint)")
        return self.rows.select("doc_id", m.alias("m"), "terms", "tfs")


def build(docs: DataFrame) -> Index:
    """The index of ``docs (doc_id, text)``, written to the shared folder. Null texts and texts without a term have no row."""
    session_of(docs)
    seen = Observation()
    terms = docs.select("doc_id", "text").mapInArrow(_terms("doc_id"), "doc_id long, n long, terms array<long>, tfs array<int>")
    counted = terms.observe(seen, F.count(F.lit(1)).alias("documents"), F.sum("n").alias("length"))
    rows = materialize(counted.sortWithinPartitions("n"), "lexical")
    return Index(rows, seen.get["documents"], seen.get["length"] or 0)


# ------------------------------------------------------------------------------------------- a block

@dataclass
class Block:
    """Some items: sorted hashes of all their terms, and per item its term numbers and repeats."""

    ids: list
    terms: np.ndarray
    wanted: list[np.ndarray]
    repeats: list[np.ndarray]

    @staticmethod
    def of(table: pa.Table) -> "Block":
        table = table.sort_by([("item_id", "ascending"), ("term", "ascending")])
        item, term, count = (table[c].to_numpy() for c in ("item_id", "term", "n"))
        terms = np.unique(term)
        number = np.searchsorted(terms, term)
        cuts = np.flatnonzero(np.diff(item)) + 1 if len(item) else []
        starts = np.concatenate([[0], cuts]).astype(np.int64) if len(item) else np.zeros(0, np.int64)
        return Block(item[starts].tolist(), terms, np.split(number, cuts) if len(item) else [], np.split(count.astype(np.int64), cuts) if len(item) else [])

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the hashes that are terms of the block, and their numbers."""
        if not len(self.terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.searchsorted(self.terms, hashes)
        at[at == len(self.terms)] = 0
        known = np.flatnonzero(self.terms[at] == hashes)
        return known, at[known]


def _frequencies(block: Block):
    """``(number, df)`` of the block's terms, once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(block.terms), np.int64)
        for batch in batches:
            df += np.bincount(block.lookup(batch["terms"].flatten().to_numpy())[1], minlength=len(df))
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["number", "df"])

    return run


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


class Run:
    """The postings of a run of documents, by term, stratum and falling frequency."""

    def __init__(self, m: np.ndarray, order: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, terms: int):
        self.order = order  # place of each document in the order of ids
        self.m, stratum = np.unique(m, return_inverse=True)
        self.sizes = np.bincount(stratum, minlength=len(self.m))
        s = stratum[doc]
        by = np.lexsort((-tf, s, term))
        self.doc, s, term, tf = doc[by], s[by], term[by], tf[by]
        new_pair = np.ones(len(by), bool)
        new_pair[1:] = (s[1:] != s[:-1]) | (term[1:] != term[:-1])
        new = new_pair.copy()
        new[1:] |= tf[1:] != tf[:-1]
        at = np.flatnonzero(new)
        self.start, self.count = at, np.diff(np.append(at, len(by)))
        self.stratum, self.highest = s[at], new_pair[at]
        t = tf[at].astype(np.int64)
        self.impact = (UNIT * t) // (TF_FACTOR * t + M_FACTOR * self.m[self.stratum])
        self.groups = np.searchsorted(term[at], np.arange(terms + 1))
        self.scores = np.zeros(len(m), np.int64)

    def best(self, numbers: np.ndarray, factor: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the k best above zero that score ``floor`` or more, ties by order of id."""
        low, size = self.groups[numbers], self.groups[numbers + 1] - self.groups[numbers]
        groups = tx.ranges(low, size)
        stratum, gain = self.stratum[groups], self.impact[groups] * np.repeat(factor, size)
        bound = np.zeros(len(self.m), np.int64)
        top = self.highest[groups]
        np.add.at(bound, stratum[top], gain[top])
        visits = np.argsort(-bound, kind="stable")
        found, worth = np.zeros(0, np.int64), np.zeros(0, np.int64)
        wave, done = 4 * k, 0
        room = np.cumsum(self.sizes[visits])
        falling = -bound[visits]
        while done < len(visits):
            # The next strata that hold ``wave`` documents, of those whose bound can still matter.
            last = int(np.searchsorted(falling, -max(floor, 1), "right"))
            if done >= last:
                break
            until = min(last, max(done + 1, int(np.searchsorted(room, (room[done - 1] if done else 0) + wave, "right"))))
            mark = np.zeros(len(self.m), bool)
            mark[visits[done:until]] = True
            at = mark[stratum]
            count = self.count[groups[at]]
            docs = self.doc[tx.ranges(self.start[groups[at]], count)]
            np.add.at(self.scores, docs, np.repeat(gain[at], count))
            docs = np.unique(docs) if len(docs) < len(self.scores) else np.flatnonzero(self.scores)
            score = self.scores[docs]
            self.scores[docs] = 0
            good = score >= max(floor, 1)
            found, worth = np.concatenate([found, docs[good]]), np.concatenate([worth, score[good]])
            if len(found) > k:
                kth = np.partition(worth, len(worth) - k)[len(worth) - k]
                near = np.flatnonzero(worth >= kth)
                near = near[np.lexsort((self.order[found[near]], -worth[near]))[:k]]
                found, worth = found[near], worth[near]
            if len(found) == k:
                floor = max(floor, int(worth.min()))
            done, wave = until, wave * 4
        return found, worth


def _search(block: Block, weight: np.ndarray, k: int):
    """``(doc_id, m, terms, tfs)`` to ``(item_id, doc_id, score)``: the k best of the task for each item."""
    factors = [weight[numbers] * repeats for numbers, repeats in zip(block.wanted, block.repeats)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int, int | None]]] = [[] for _ in block.ids]  # (-score, place of null, id)

        def search(parts: list) -> None:
            ids = [x for part in parts for x in part[0]]
            first = np.concatenate([[0], np.cumsum([len(p[0]) for p in parts])])
            m = np.concatenate([p[1] for p in parts])
            doc = np.concatenate([p[2] + f for p, f in zip(parts, first)])
            term, tf = (np.concatenate([p[c] for p in parts]) for c in (3, 4))
            order = np.empty(len(ids), np.int64)
            order[sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))] = np.arange(len(ids))
            index = Run(m, order, doc, term, tf, len(block.terms))
            for n, numbers in enumerate(block.wanted):
                floor = -best[n][-1][0] if len(best[n]) == k else 0
                docs, scores = index.best(numbers, factors[n], k, floor)
                if len(docs):
                    fresh = [(-int(s), ids[d] is None, ids[d]) for d, s in zip(docs.tolist(), scores.tolist())]
                    best[n] = sorted(best[n] + fresh, key=lambda x: (x[0], x[1], x[2] or 0))[:k]

        parts, held = [], 0
        for batch in batches:
            counts = batch["terms"].value_lengths().to_numpy(zero_copy_only=False)
            known, number = block.lookup(batch["terms"].flatten().to_numpy())
            row = np.repeat(np.arange(batch.num_rows), counts)[known]
            parts.append((batch["doc_id"].to_pylist(), batch["m"].to_numpy(zero_copy_only=False), row, number,
                          batch["tfs"].flatten().to_numpy()[known].astype(np.int64)))
            held += len(known) + batch.num_rows
            if held >= RUN_POSTINGS:
                search(parts)
                parts, held = [], 0
        if parts:
            search(parts)
        flat = [(i, x) for i, found in zip(block.ids, best) for x in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in flat], pa.int64()), pa.array([x[2] for _, x in flat], pa.int64()),
             pa.array([-x[0] for _, x in flat], pa.int64())], ["item_id", "doc_id", "score"])

    return run


def search(index: Index, items: DataFrame, *, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of each item of ``items (item_id, text)``, score above 0.

    Equal scores rank by ascending id, null ids last. Every row of the index is a document: repeated ids and
    rows each may take a rank. Items without an id, a term, or a document that shares a weighty term give no
    rows; equal item rows count once, and different texts of one id make one item. Whole texts count; other
    columns are not read; empty tables give no rows.
    """
    spark = session_of(items)
    asked = items.where("item_id is not null").select("item_id", "text").distinct().mapInArrow(
        _terms("item_id"), "item_id long, n long, terms array<long>, tfs array<int>")
    pairs = asked.select("item_id", F.explode(F.arrays_zip("terms", "tfs")).alias("p")).groupBy(
        "item_id", F.col("p.terms").alias("term")).agg(F.sum("p.tfs").alias("n"))
    pairs = materialize(pairs, "item_terms")
    blocks = max(1, -(-pairs.count() // BLOCK_TERMS))
    rows, parts = index.normalised(), []
    for number in range(blocks):
        block = Block.of(pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number).toArrow())
        df = np.zeros(len(block.terms), np.int64)
        counted = rows.select("terms").mapInArrow(_frequencies(block), "number long, df long")
        for at, n in counted.groupBy("number").agg(F.sum("df").alias("df")).collect():
            df[at] = n
        parts.append(materialize(rows.mapInArrow(
            _search(block, weights(df, index.documents), k), "item_id long, doc_id long, score long"), "found"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
