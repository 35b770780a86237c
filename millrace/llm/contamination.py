"""Benchmark passages in documents: a prefix-filtered set join with positional verification.

An item is cut into windows of ``window`` words (a shorter item is one window). A document contains
a window only if it contains its rarest word, so one prefix token per window is enough for exact
containment. Words are ordered by their frequency in the documents (counted in a first pass, for
the words of the items only), the rarest word of each window is looked up among all document words,
bounds on position and length drop what cannot fit, and the rest is compared word by word.

Windows of the items are held by the tasks in blocks of at most ``BLOCK_WINDOWS`` (a few megabytes).
More windows make more blocks, each a pass over the documents. The driver holds all blocks at once, and
a window holds the ids of all its items, so the benchmark must fit in the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.lineage import materialize
from millrace.llm import text as tx
from millrace.llm.frames import session_of

BLOCK_WINDOWS = 100_000

_SPANS = "array<struct<start:long,stop:long>>"


def _hashed(batch: pa.RecordBatch) -> tuple[tx.Words, np.ndarray]:
    data, offsets = tx.utf8(batch["text"])
    words = tx.Words(tx.lower_ascii(data), offsets, tx.ALNUM)
    return words, words.hashes()


def _windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.pieces(batches, "text"):
            words, hashes = _hashed(batch)
            counts = words.counts
            number = np.where(counts >= window, counts - window + 1, np.minimum(counts, 1))
            width = np.repeat(np.minimum(counts, window), number)
            start = tx.ranges(words.rows[:-1], number)
            body = tx.signed(hashes)[tx.ranges(start, width)]
            item = batch["item_id"].take(pa.array(np.repeat(np.arange(batch.num_rows), number)))
            yield pa.RecordBatch.from_arrays([item, tx.lists(body, width)], ["item_id", "words"])

    return run


def _frequencies(vocabulary: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in tx.pieces(batches, "text"):
            _, hashes = _hashed(batch)
            at = np.searchsorted(vocabulary, hashes)
            at[at == len(vocabulary)] = 0
            total += np.bincount(at[vocabulary[at] == hashes], minlength=len(vocabulary))
        seen = total > 0
        yield pa.RecordBatch.from_arrays([pa.array(tx.signed(vocabulary)[seen]), pa.array(total[seen])], ["word", "n"])

    return run


class Block:
    """Windows by their rarest word: flat arrays, so that it travels to the tasks as it is."""

    def __init__(self, windows: list[np.ndarray], items: list[list[int]], frequency: dict[int, int]):
        size = np.array([len(w) for w in windows], np.int64)
        body = np.concatenate(windows) if windows else np.zeros(0, np.uint64)
        rows = np.concatenate([[0], np.cumsum(size)])
        count = np.array([frequency.get(int(w), 0) for w in body], np.int64)
        # The least (frequency, word) of each window is its prefix token.
        order = np.lexsort((body, count, np.repeat(np.arange(len(size)), size)))
        pick = order[rows[:-1]]
        by = np.argsort(body[pick], kind="stable")
        self.size, self.offset = size[by], (pick - rows[:-1])[by]
        self.token, first = np.unique(body[pick][by], return_index=True)
        self.first = np.append(first, len(size))
        self.rows = np.concatenate([[0], np.cumsum(self.size)])
        self.body = np.concatenate([windows[i] for i in by]) if windows else body
        self.items = [items[i] for i in by]

    def find(self, words: tx.Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(row, first word in the batch, window)`` of every occurrence."""
        empty = np.zeros(0, np.int64)
        if not len(self.token) or not len(hashes):
            return empty, empty, empty
        slot = np.searchsorted(self.token, hashes)
        slot[slot == len(self.token)] = 0
        at = np.flatnonzero(self.token[slot] == hashes)
        slot = slot[at]
        number = self.first[slot + 1] - self.first[slot]
        window = tx.ranges(self.first[slot], number)
        start = np.repeat(at, number) - self.offset[window]
        row = np.repeat(np.searchsorted(words.rows, at, "right") - 1, number)
        fits = (start >= words.rows[row]) & (start + self.size[window] <= words.rows[row + 1])
        row, start, window = row[fits], start[fits], window[fits]
        for k in range(int(self.size.max())):
            more = self.size[window] > k
            same = ~more
            same[more] = hashes[start[more] + k] == self.body[self.rows[window[more]] + k]
            row, start, window = row[same], start[same], window[same]
        return row, start, window


def merged(start: np.ndarray, stop: np.ndarray) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(zip(start.tolist(), stop.tolist())):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _matches(block: Block, all_rows: bool):
    kinds = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.pieces(batches, "text"):
            words, hashes = _hashed(batch)
            row, start, window = block.find(words, hashes)
            spans, items = [[] for _ in range(batch.num_rows)], [[] for _ in range(batch.num_rows)]
            order = np.argsort(row, kind="stable")
            row, start, window = row[order], start[order], window[order]
            cuts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else row
            for low, high in zip(cuts, np.append(cuts[1:], len(row))):
                at, w = row[low], window[low:high]
                begin = start[low:high] - words.rows[at]
                spans[at] = [{"start": a, "stop": b} for a, b in merged(begin, begin + block.size[w])]
                items[at] = sorted({i for k in np.unique(w) for i in block.items[k]})
            keep = pa.array(np.array([all_rows or bool(s) for s in spans], bool))
            yield pa.RecordBatch.from_arrays([
                batch["row"].filter(keep), batch["doc_id"].filter(keep), pa.array(words.counts).filter(keep),
                pa.array(spans, kinds).filter(keep), pa.array(items, pa.list_(pa.int64())).filter(keep)],
                ["row", "doc_id", "n_words", "hits", "items"])

    return run


def _blocks(docs: DataFrame, benchmark: DataFrame, window: int, block_windows: int) -> list[Block]:
    """The benchmark's distinct windows in blocks of bounded size; at least one, maybe empty."""
    per_item = benchmark.where("item_id is not null").select("item_id", "text").mapInArrow(
        _windows(window), "item_id long, words array<long>")
    distinct = materialize(per_item.groupBy("words").agg(F.collect_set("item_id").alias("items")), "windows")
    count = max(1, -(-distinct.count() // block_windows))
    blocks = []
    for number in range(count):
        held = distinct.where(F.pmod(F.xxhash64("words"), F.lit(count)) == number).collect()
        windows = [np.array(r["words"], np.int64).view(np.uint64) for r in held]
        vocabulary = np.unique(np.concatenate(windows)) if windows else np.zeros(0, np.uint64)
        counted = docs.select("text").mapInArrow(_frequencies(vocabulary), "word long, n long").groupBy("word").agg(
            F.sum("n").alias("n")).collect() if windows else []
        blocks.append(Block(windows, [list(r["items"]) for r in held], {r["word"] % 2**64: r["n"] for r in counted}))
    return blocks


def _reject(block: Block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.pieces(batches, "text"):
            row, _, _ = block.find(*_hashed(batch))
            keep = np.ones(batch.num_rows, bool)
            keep[row] = False
            yield batch.filter(pa.array(keep))

    return run


def without_contaminated(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The rows of ``docs`` that hold no window of any item, with all their columns; rows do not move."""
    session_of(docs)
    for block in _blocks(docs, benchmark, window, block_windows):
        docs = docs.mapInArrow(_reject(block), docs.schema)
    return docs


def contaminated(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``doc_id, n_words, hits (array of word spans), items (array of item ids)`` per row of ``docs``.

    Texts are lower-cased in A-Z; words are runs of letters, digits and bytes beyond ASCII. ``hits``
    covers every word of every occurrence of an item's window, ``items`` lists the items with one.
    Null texts have no words; items without words and items with a null id are left out. Rows with a
    null id, repeated ids and repeated rows each give a row. Other columns are not read. An empty
    table of documents gives no rows, an empty benchmark no hits.
    """
    session_of(docs)
    rows = docs.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", "text")
    kind = f"row long, doc_id long, n_words long, hits {_SPANS}, items array<long>"
    parts = [rows.mapInArrow(_matches(block, number == 0), kind)
             for number, block in enumerate(_blocks(docs, benchmark, window, block_windows))]
    if len(parts) == 1:
        return parts[0].drop("row")
    found = parts[0]
    for part in parts[1:]:
        # Equal rows give equal finds; one of them is enough to add to each.
        more = materialize(part.groupBy(F.col("row").alias("r"), F.col("doc_id").alias("d")).agg(
            F.first("hits").alias("h"), F.first("items").alias("i")), "hits")
        found = found.join(more, (F.col("row") == F.col("r")) & F.col("doc_id").eqNullSafe(F.col("d")), "left").select(
            "row", "doc_id", "n_words",
            F.concat("hits", F.coalesce("h", F.array().cast(_SPANS))).alias("hits"),
            F.array_sort(F.array_union("items", F.coalesce("i", F.array().cast("array<long>")))).alias("items"))
    return found.mapInArrow(_join_spans, kind).drop("row")


def _join_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [merged(np.array([x["start"] for x in s]), np.array([x["stop"] for x in s])) if s else [] for s in batch["hits"].to_pylist()]
        kinds = batch.schema.field("hits").type
        hits = pa.array([[{"start": a, "stop": b} for a, b in s] for s in spans], kinds)
        yield pa.RecordBatch.from_arrays([batch["row"], batch["doc_id"], batch["n_words"], hits, batch["items"]], batch.schema.names)
