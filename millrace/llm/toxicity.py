"""Toxic passages by maximum-scoring segments of token log-odds, with extreme-value calibration.

Fitting, on at most ``SAMPLE`` labelled documents (a random subset by hash of the id):

* three quarters give token log-odds between toxic and clean documents with an informative Dirichlet
  prior (the pooled frequency of the token); tokens are the words and, for inflected and compound
  forms, their beginnings of ``STEMS`` bytes. A toxic document counts for a token only as far as it
  brings new contexts (the words around a word, the words that begin with a beginning), so copies of one
  text do not make its words toxic, nor one toxic word all that begin like it. Only
  tokens whose log-odds stand ``Z`` standard errors off zero, and at ``LEAST`` or more after they are
  shrunk by one, score; a word gets the score of its strongest token less ``DRIFT``;
* the clean token frequencies give the decay ``lambda`` of chance segment scores, the clean documents
  of the last quarter the scale ``K`` of the extreme-value law;
* that quarter also fits the logistic map from evidence to probability.

Scoring, on all texts: one linear scan finds all maximal scoring segments; a segment of score S in n
words is expected ``E = K n exp(-lambda S)`` times by chance. Those with E below ``SIGNIFICANT`` are the
toxic passages, and the evidence of a document is the sum of their ``-log E``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.lineage import materialize
from millrace.llm import text as tx
from millrace.llm.frames import session_of

SAMPLE = 20_000
PRIOR, Z, LEAST, DRIFT, SIGNIFICANT = 50.0, 3.5, 1.5, 0.3, 0.05
STEMS = (3, 4, 5, 6, 7, 8)

_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())]))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(start, stop, score)`` of a row of token scores, in order.

    The linear-time scan: each positive run is joined with earlier segments while that raises the
    score. Runs between positive tokens are only passed through their prefix sums.
    """
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    breaks = np.flatnonzero(np.diff(positive) > 1)
    starts = positive[np.concatenate([[0], breaks + 1])]
    stops = positive[np.concatenate([breaks, [len(positive) - 1]])] + 1
    # Per held segment: start, stop, sum before, sum behind, nearest earlier one with a smaller sum before.
    held: list[tuple[int, int, float, float, int]] = []
    for start, stop, left, right in zip(starts.tolist(), stops.tolist(), sums[starts].tolist(), sums[stops].tolist()):
        at = len(held) - 1
        while True:
            while at >= 0 and held[at][2] >= left:
                at = held[at][4]
            if at < 0 or held[at][3] >= right:
                held.append((start, stop, left, right, at))
                break
            start, left = held[at][0], held[at][2]
            link = held[at][4]
            del held[at:]
            at = link
    return [(a, b, r - l) for a, b, l, r, _ in held]


@dataclass
class Model:
    words: np.ndarray  # sorted hashes of scoring words
    scores: np.ndarray
    decay: float
    scale: float
    weights: tuple[float, float, float]

    def word_scores(self, tokens: list[np.ndarray]) -> np.ndarray:
        """Scores of words from the hashes of each kind of token."""
        best = np.zeros(len(tokens[0]))
        if len(self.words):
            for hashes in tokens:
                at = np.searchsorted(self.words, hashes)
                at[at == len(self.words)] = 0
                known = np.flatnonzero(self.words[at] == hashes)
                found = self.scores[at[known]]
                best[known] = np.where(np.abs(found) > np.abs(best[known]), found, best[known])
        return best - DRIFT

    def passages(self, segments: list, length: int) -> list[tuple[int, int, float]]:
        """Significant segments with ``-log E`` in place of the score."""
        base = math.log(self.scale * max(length, 1))
        found = [(a, b, self.decay * s - base) for a, b, s in segments]
        return [x for x in found if x[2] > -math.log(SIGNIFICANT)]

    def probability(self, evidence: float, count: int) -> float:
        w = self.weights
        x = w[0] + w[1] * math.log1p(evidence) + w[2] * math.log1p(count)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def _tokens(batch: pa.RecordBatch) -> tuple[tx.Words, list[np.ndarray]]:
    """Words, and the hash of each word and of its beginnings (that of the word where it is no longer)."""
    data, offsets = tx.utf8(batch["text"])
    words = tx.Words(tx.lower_ascii(data), offsets, tx.ALNUM)
    return words, [words.hashes(), *words.heads(STEMS)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(text, label)`` to ``(word, toxic docs, clean docs, clean tokens)``."""
    for batch in tx.pieces(batches, "text"):
        words, tokens = _tokens(batch)
        row = tx.row_of(words.rows)
        longer = [words.stop - words.start > k for k in STEMS]
        hashes = np.concatenate([tokens[0], *(t[more] for t, more in zip(tokens[1:], longer))])
        row = np.concatenate([row, *(row[more] for more in longer)])
        toxic = batch["label"].to_numpy(zero_copy_only=False).astype(np.int64) == 1
        order = np.lexsort((row, hashes))
        h, r = hashes[order], row[order]
        head = np.ones(len(h), bool)
        head[1:] = h[1:] != h[:-1]
        fresh = head.copy()
        fresh[1:] |= r[1:] != r[:-1]
        at = np.flatnonzero(head)
        add = lambda x: np.add.reduceat(x.astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([
            pa.array(tx.signed(h[at])), pa.array(add(fresh & toxic[r])), pa.array(add(fresh & ~toxic[r])),
            pa.array(add(~toxic[r]))], ["word", "td", "cd", "ct"])


def _contexts(wanted: np.ndarray):
    """Toxic texts to distinct ``(token, context)`` of the wanted tokens, per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.pieces(batches, "text"):
            words, tokens = _tokens(batch)
            plain = tokens[0]
            padded = np.concatenate([[np.uint64(0)], plain, [np.uint64(0)]]).astype(np.uint64)
            # The neighbours at the edge of a text belong to another one; that only adds a context.
            around = tx.mix(padded[:-2] ^ tx.mix(padded[2:] + np.uint64(1))) if len(plain) else plain
            found = set()
            for number, hashes in enumerate(tokens):
                at = np.searchsorted(wanted, hashes)
                at[at == len(wanted)] = 0
                known = wanted[at] == hashes
                seen_in = around if number == 0 else plain
                found.update(zip(tx.signed(hashes[known]).tolist(), tx.signed(seen_in[known]).tolist()))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["word", "around"])

    return run


def _scan(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.pieces(batches, "text"):
            words, tokens = _tokens(batch)
            scores = model.word_scores(tokens)
            spans, chance = [], []
            any_positive = np.add.reduceat(np.append(scores > 0, False).astype(np.int64), words.rows[:-1]) if batch.num_rows else []
            for at in range(batch.num_rows):
                low, high = words.rows[at], words.rows[at + 1]
                # An empty row repeats what follows in reduceat; its slice is empty all the same.
                found = maximal_segments(scores[low:high]) if high > low and any_positive[at] else []
                chance.append(max((s for _, _, s in found), default=0.0))
                spans.append(found)
            kept = [model.passages(s, n) for s, n in zip(spans, words.counts.tolist())]
            score = [model.probability(sum(x[2] for x in k), len(k)) for k in kept]
            yield pa.RecordBatch.from_arrays([
                *(batch[c] for c in batch.schema.names if c != "text"), pa.array(words.counts), pa.array(chance),
                pa.array([[{"start": a, "stop": b, "score": e} for a, b, e in k] for k in kept], _SPANS),
                pa.array(score, pa.float64())],
                [*(c for c in batch.schema.names if c != "text"), "n_words", "best", "passages", "score"])

    return run


_SCANNED = "n_words long, best double, passages array<struct<start:long,stop:long,score:double>>, score double"


def _decay(scores: np.ndarray, share: np.ndarray) -> float:
    """The positive root of ``sum(share * exp(x * score)) = 1``; the mean score is negative."""
    low, high = 0.0, 1.0
    value = lambda x: float((share * np.exp(np.minimum(x * scores, 700))).sum()) - 1
    while value(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if value(middle) < 0 else (low, middle)
    return high


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6, *[1e-2] * (x.shape[1] - 1)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(len(w)), x.T @ (y - p) - ridge @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> Model:
    """A model from ``docs (doc_id, text)`` and ``labels (doc_id, label)``; null labels, ids and texts are left out.

    Equal texts count once, with the larger of their labels.

    Without labelled rows of both kinds, every score is the share of toxic rows (one half without rows).
    """
    session_of(docs)
    draw = F.xxhash64(F.col("doc_id"), F.lit("toxicity"))
    picked = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    picked = picked.orderBy(draw).limit(sample).withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(4)))
    # The sample is bounded by its size, so it may be broadcast; documents are not shuffled.
    rows = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    rows = materialize(rows.groupBy("text").agg(F.max("label").alias("label"), F.min("fold").alias("fold")), "labelled")
    learn, check = rows.where("fold > 0"), rows.where("fold = 0")
    sizes = {r["label"]: r["n"] for r in learn.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sum(n for k, n in sizes.items() if k != 1)
    if not toxic or not clean:
        share = min(max(toxic / (toxic + clean) if toxic + clean else 0.5, 1e-6), 1 - 1e-6)
        return Model(np.zeros(0, np.uint64), np.zeros(0), 1.0, 1.0, (math.log(share / (1 - share)), 0.0, 0.0))
    counts = learn.select("text", F.col("label").cast("int").alias("label")).mapInArrow(
        _count, "word long, td long, cd long, ct long").groupBy("word").agg(
            F.sum("td").alias("td"), F.sum("cd").alias("cd"), F.sum("ct").alias("ct"))
    prior = F.lit(PRIOR) * (F.col("td") + F.col("cd")) / F.lit(float(toxic + clean))
    odds = lambda seen, n: F.log((F.col(seen) + prior) / (F.lit(n + PRIOR) - F.col(seen) - prior + 0.5))
    scored = counts.withColumn("delta", odds("td", float(toxic)) - odds("cd", float(clean))).withColumn(
        "sigma", F.sqrt(1 / (F.col("td") + prior) + 1 / (F.col("cd") + prior)))
    total = max(1, counts.agg(F.sum("ct").alias("n")).first()["n"] or 1)
    kept = scored.where((F.abs("delta") > Z * F.col("sigma")) & (F.abs("delta") - F.col("sigma") >= LEAST)).orderBy("word").collect()
    words = np.sort(np.array([r["word"] for r in kept], np.int64).view(np.uint64))
    distinct = {r["word"]: r["n"] for r in learn.where("label = 1").select("text").mapInArrow(
        _contexts(words), "word long, around long").distinct().groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()} if kept else {}
    word, td, cd, ct = (np.array([r[k] for r in kept], np.int64) for k in ("word", "td", "cd", "ct"))
    seen = np.minimum(td, [distinct.get(int(w), 0) for w in word]) if kept else td
    a = PRIOR * (td + cd) / (toxic + clean)
    delta = np.log((seen + a) / (toxic + PRIOR - seen - a + 0.5)) - np.log((cd + a) / (clean + PRIOR - cd - a + 0.5))
    sigma = np.sqrt(1 / (seen + a) + 1 / (cd + a))
    firm = (np.abs(delta) > Z * sigma) & (np.abs(delta) - sigma >= LEAST)
    words = word[firm].view(np.uint64)
    scores = np.copysign(np.abs(delta) - sigma, delta)[firm]
    share = (ct[firm] + 0.5) / total
    order = np.argsort(words)
    words, scores, share = words[order], scores[order], share[order]
    values = np.append(scores - DRIFT, -DRIFT)
    parts = np.append(share, max(1 - share.sum(), 0.0)) if len(share) else np.ones(1)
    decay = _decay(values, parts / parts.sum()) if (values > 0).any() else 1.0
    model = Model(words, scores, decay, 1.0, (0.0, 0.0, 0.0))

    checked = check.select("label", "text").mapInArrow(_scan(model), "label int, " + _SCANNED).select("label", "n_words", "best").collect()
    quiet = [decay * r["best"] - math.log(max(r["n_words"], 1)) for r in checked if r["label"] != 1 and r["best"] > 0]
    quiet_share = len(quiet) / max(1, sum(r["label"] != 1 for r in checked))
    # Mean of a Gumbel law is its location plus 0.5772; documents without a segment pull it down.
    model.scale = min(max(math.exp(float(np.mean(quiet)) - 0.5772) * quiet_share, 1e-6), 1e3) if quiet else 1e-3
    again = check.select("label", "text").mapInArrow(_scan(model), "label int, " + _SCANNED).select(
        "label", F.size("passages").alias("k"), F.aggregate("passages", F.lit(0.0), lambda a, x: a + x["score"]).alias("e")).collect()
    if again:
        x = np.array([[1.0, math.log1p(r["e"]), math.log1p(r["k"])] for r in again])
        model.weights = tuple(_logistic(x, np.array([float(r["label"] == 1) for r in again])))
    else:
        model.weights = (math.log(toxic / clean), 1.0, 0.0)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, n_words, passages (array of word spans with -log E), score`` per row of ``docs``.

    Whole texts are scanned. Null and blank texts have no passage and get the score of a text without
    one. Null ids, repeated ids and repeated rows each give a row; other columns are not read; an empty
    table gives no rows.
    """
    session_of(docs)
    return docs.select("doc_id", "text").mapInArrow(_scan(model), "doc_id long, " + _SCANNED).drop("best")


def _reject(model: Model, threshold: float):
    scan = _scan(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.pieces(batches, "text"):
            scored = next(scan(iter([batch.select(["text"])])))
            yield batch.filter(pa.array(scored["score"].to_numpy() < threshold))

    return run


def without_toxic(docs: DataFrame, model: Model, *, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns; rows do not move."""
    session_of(docs)
    return docs.mapInArrow(_reject(model, threshold), docs.schema)
