"""Approximate nearest neighbours with a hash-prefix forest.

Each of ``TREES`` trees gives a vector a string of ``DEPTH`` bits, the sides of random hyperplanes
through the medians of a bounded sample. A tree is the sorted array of these strings, so the vectors
that share a prefix with a query stand together. A query descends in every tree to the longest prefix
it shares with anyone, then ascends in all trees at once, one bit at a time, until the prefixes hold
``SPREAD`` entries for each vector. Each tree gives the candidates under its prefix as many votes as bits
they share with the query. Those with most votes, a share ``COMPARED`` of the vectors, are compared exactly,
in double precision on the original vectors: a near vector stands close in many trees, a far one in few.

Vectors are indexed where they are read, in shards of at most ``SHARD`` rows, and no vector moves.
Queries visit every shard in blocks of at most ``BLOCK`` queries, each a pass over the vectors. Only the
``k`` best of each query and shard are shuffled, and are cut again before that.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.lineage import materialize
from millrace.llm import text as tx
from millrace.llm.frames import session_of

TREES, DEPTH = 128, 32
SAMPLE = 4096  # vectors that place the hyperplanes
SHARD, BLOCK = 16_384, 2048
SPREAD = 10.0  # entries of all trees, for each vector of a shard, at which the ascent ends
COMPARED = 0.075  # share of a shard's vectors that is compared exactly
LEAST = 20  # compared vectors for each neighbour asked for, where the share gives fewer

_FOUND = "query_id long, vec_id long, score double"


def vectors(ids: pa.Array, column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Usable vectors by dimension: ``(ids, matrix)``; null, zero and non-finite ones take no part."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64)
    sizes[~ids.is_valid().to_numpy(zero_copy_only=False)] = 0
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64)
    start = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    names = ids.fill_null(0).to_numpy(zero_copy_only=False)
    out = {}
    for d in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == d)
        matrix = flat[start[rows][:, None] + np.arange(d)]
        good = np.isfinite(matrix).all(axis=1) & (matrix != 0).any(axis=1)
        if good.any():
            out[int(d)] = (names[rows[good]], matrix[good])
    return out


@dataclass
class Planes:
    normals: np.ndarray  # (dimension, TREES * DEPTH)
    shift: np.ndarray

    def codes(self, matrix: np.ndarray) -> np.ndarray:
        """Hash strings as integers, first bit on top: ``(TREES, n)``."""
        bits = (matrix @ self.normals > self.shift).reshape(len(matrix), TREES, DEPTH)
        weights = np.uint64(1) << np.arange(DEPTH - 1, -1, -1, dtype=np.uint64)
        return np.ascontiguousarray((bits * weights).sum(axis=2, dtype=np.uint64).T)


def planes(sample: np.ndarray) -> Planes:
    """Random hyperplanes through the medians of the distinct vectors of a sample."""
    sample = np.unique(sample, axis=0)
    normals = np.random.default_rng(sample.shape[1]).normal(size=(sample.shape[1], TREES * DEPTH))
    return Planes(normals, np.median(sample @ normals, axis=0))


def _ascend(codes: np.ndarray, asked: np.ndarray, enough: float) -> tuple[np.ndarray, np.ndarray]:
    """Ranges ``(TREES, queries)`` in the sorted trees: the longest common prefix length that gives enough entries."""
    size, count = codes.shape[1], asked.shape[1]
    low, high = np.zeros((TREES, count), np.int64), np.full((TREES, count), size, np.int64)
    open_queries = np.arange(count)
    for level in range(DEPTH, 0, -1):  # one bit less in every tree
        rest = np.uint64((1 << (DEPTH - level)) - 1)
        a, b = (np.empty((TREES, len(open_queries)), np.int64) for _ in range(2))
        for t in range(TREES):
            q = asked[t, open_queries]
            a[t], b[t] = np.searchsorted(codes[t], q & ~rest, "left"), np.searchsorted(codes[t], q | rest, "right")
        done = (b - a).sum(axis=0) >= enough
        low[:, open_queries[done]], high[:, open_queries[done]] = a[:, done], b[:, done]
        open_queries = open_queries[~done]
        if not len(open_queries):
            break
    return low, high


def _most_voted(votes: np.ndarray, wanted: int) -> np.ndarray:
    """Positions with most votes: as many whole levels of votes as come nearest to ``wanted`` from above."""
    if wanted >= len(votes):
        return np.arange(len(votes))
    at_least = np.cumsum(np.bincount(votes)[::-1])[::-1]  # vectors with that many votes or more
    levels = np.flatnonzero(at_least >= wanted)
    return np.flatnonzero(votes >= levels[-1])


def search(index: Planes, names: np.ndarray, matrix: np.ndarray, query_names: np.ndarray, queries: np.ndarray, k: int,
           compared: float = COMPARED) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """The k nearest candidates of each query in one shard: ``(query, ids, distances, vectors compared)``.

    Equal vectors are one candidate with many ids, so copies of one vector do not take the place of others.
    """
    _, first, which = np.unique(np.ascontiguousarray(matrix).view(f"V{8 * matrix.shape[1]}").ravel(), return_index=True, return_inverse=True)
    by_vector = np.lexsort((names, which))
    ids, begin = names[by_vector], np.concatenate([[0], np.cumsum(np.bincount(which))])
    matrix = matrix[first]
    codes, asked = index.codes(matrix), index.codes(queries)
    order = np.argsort(codes, axis=1, kind="stable")
    codes = np.take_along_axis(codes, order, axis=1)
    low, high = _ascend(codes, asked, min(SPREAD, TREES) * len(matrix))
    wanted = max(LEAST * k, int(compared * len(matrix)))
    for at in range(len(queries)):
        parts = [slice(a, b) for a, b in zip(low[:, at], high[:, at])]
        held = np.concatenate([order[t, part] for t, part in enumerate(parts)])
        differ = np.concatenate([codes[t, part] ^ asked[t, at] for t, part in enumerate(parts)])
        shared = DEPTH - np.frexp(differ.astype(np.float64))[1]  # the exponent is the place of the first bit that differs
        found = _most_voted(np.bincount(held, shared, minlength=len(matrix)).astype(np.int64), wanted)
        distance = np.sqrt(((matrix[found] - queries[at]) ** 2).sum(axis=1))
        number = len(found)
        most = k + int((names == query_names[at]).sum())  # rows of the query's own id fall away below
        if number > most:
            # Keep ties at the border; they are ordered by id.
            near = distance <= np.partition(distance, most - 1)[most - 1]
            found, distance = found[near], distance[near]
        copies = np.minimum(begin[found + 1] - begin[found], most)
        name, distance = ids[tx.ranges(begin[found], copies)], np.repeat(distance, copies)
        name, distance = name[name != query_names[at]], distance[name != query_names[at]]
        best = np.lexsort((name, distance))[:k]
        yield int(query_names[at]), name[best], distance[best], number


def _shards(index: dict[int, Planes], asked: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    def emit(d, parts):
        names, matrix = (np.concatenate(x) for x in zip(*parts))
        rows = list(search(index[d], names, matrix, *asked[d], k))
        count = np.array([len(r[1]) for r in rows], np.int64)
        return pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.array([r[0] for r in rows], np.int64), count)),
            pa.array(np.concatenate([r[1] for r in rows])), pa.array(np.concatenate([r[2] for r in rows]))],
            ["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {d: [] for d in asked}
        for batch in batches:
            for d, part in vectors(batch["vec_id"], batch["embedding"]).items():
                if d not in held:
                    continue
                held[d].append(part)
                if sum(len(x[0]) for x in held[d]) >= SHARD:
                    yield emit(d, held[d])
                    held[d] = []
        for d, parts in held.items():
            if parts:
                yield emit(d, parts)

    return run


def nearest(rows: DataFrame, queries: DataFrame, *, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found rows for every query, nearest first.

    Both frames hold ``vec_id`` (long) and ``embedding`` (array of numbers). The score is the Euclidean
    distance in double precision; ties go to the smaller id. A query's own id is no candidate. Null, zero
    and non-finite vectors and null ids take no part, and vectors of another dimension are no candidates.
    Queries that repeat an id count once, with the least vector; rows that repeat an id are candidates
    each. An empty table gives no rows. The sample that places the hyperplanes are the ``SAMPLE`` rows whose
    ids have the smallest hashes; for a dimension that it misses, the queries of the first block that has it.
    """
    session_of(rows)
    asked = materialize(queries.where("vec_id is not null and embedding is not null").groupBy("vec_id").agg(
        F.min("embedding").alias("embedding")), "queries")
    total = asked.count()
    blocks = max(1, -(-total // BLOCK))
    sample = rows.where("vec_id is not null and embedding is not null").orderBy(F.xxhash64("vec_id"), "vec_id").select(
        "vec_id", "embedding").limit(SAMPLE).toArrow() if total else None
    index = {d: planes(matrix) for d, (_, matrix) in vectors(
        sample["vec_id"].combine_chunks(), sample["embedding"]).items()} if sample is not None else {}
    parts = []
    for number in range(blocks):
        table = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == number).orderBy("vec_id").toArrow()
        block = vectors(table["vec_id"].combine_chunks(), table["embedding"])
        for d, (_, matrix) in block.items():
            if d not in index:
                index[d] = planes(matrix)
        if block:
            parts.append(rows.select("vec_id", "embedding").mapInArrow(_shards(index, block, k), _FOUND))
    if not parts:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    found = reduce(DataFrame.union, parts).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
