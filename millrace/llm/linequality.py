"""Document quality from a linear-chain conditional random field over lines.

Every line that is not blank is a position of the chain and gets one of two labels, good or bad. Its
features describe the line itself and both neighbours: each measured value is cut at quantiles of the
sample into bins, and each (side, feature, bin) has one weight. Two labels and a 2 x 2 table of
transitions make the chain, so only the difference of the labels' scores counts.

Labels are known per document; while fitting, all lines of a document carry that of the document. Fitting
maximises the conditional likelihood of the label rows by its exact gradient, the forward-backward
marginals, on a sample of at most ``SAMPLE`` labelled documents and ``SAMPLE_LINES`` lines of each. Scoring
reads whole texts: marginals of all lines come from two products of 2 x 2 matrices along the chain,
formed by doubling, so that a text of very many lines takes no loop over lines. The marginals, weighted
by the characters of their lines, give the share of good text; a logistic map fitted on a quarter of the
sample that the chain has not seen turns the share into a probability.
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

SAMPLE, SAMPLE_LINES = 6_000, 200
BINS, ROUNDS, RATE, RIDGE = 8, 150, 0.15, 1e-4
FEATURES = ("bytes", "words", "word_bytes", "upper", "digits", "spaces", "punctuation", "other", "capitals",
            "distinct", "repeated", "doubled", "seen", "ended", "runs")
_SEEN = 4  # words in a row that mark a repetition

_KIND = np.full(256, 5, np.int64)  # 0 lower, 1 upper, 2 digit, 3 space, 4 sentence punctuation, 5 other ASCII, 6 beyond ASCII
_KIND[0x61:0x7B], _KIND[0x41:0x5B], _KIND[0x30:0x3A], _KIND[[0x20, *range(0x09, 0x0E)]] = 0, 1, 2, 3
_KIND[[ord(c) for c in ".,;:!?'\"()-"]] = 4
_KIND[0x80:] = 6
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\":"]] = True


# -------------------------------------------------------------------------------------------- lines

@dataclass
class Lines:
    """The lines of a batch that are not blank: per row the range of its lines, and per line its values."""

    rows: np.ndarray
    chars: np.ndarray
    values: np.ndarray


def _first_of_row(row: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether no earlier element of the same row has the same key."""
    order = np.lexsort((np.arange(len(key)), key, row))
    again = np.zeros(len(key), bool)
    r, k = row[order], key[order]
    again[order[1:]] = (r[1:] == r[:-1]) & (k[1:] == k[:-1])
    return ~again


def measure(data: np.ndarray, offsets: np.ndarray) -> Lines:
    """Lines of the texts whose UTF-8 bytes are ``data[offsets[i]:offsets[i + 1]]``, cut at line feeds."""
    words = tx.Words(data, offsets, tx.NOT_SPACE)
    cut = np.unique(np.concatenate([offsets, np.flatnonzero(data == 0x0A) + 1]))
    start, stop = cut[:-1], cut[1:]
    first = np.searchsorted(words.start, start)
    count = np.searchsorted(words.start, stop) - first
    kept = count > 0
    start, stop, first, count = start[kept], stop[kept], first[kept], count[kept]
    n = len(start)
    row = np.searchsorted(offsets, start, "right") - 1
    if not n:
        return Lines(np.zeros(len(offsets), np.int64), np.zeros(0, np.int64), np.zeros((0, len(FEATURES))))
    kinds = _KIND[data]
    share = np.empty((n, 7))
    for k in range(7):
        sums = np.concatenate([[0], np.cumsum(kinds == k)])
        share[:, k] = sums[stop] - sums[start]
    size = stop - start
    # Lead bytes of UTF-8 count characters.
    leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    word_sum = lambda x: np.add.reduceat(x.astype(np.float64), first)
    hashes = tx.Words(tx.lower_ascii(data), offsets, tx.NOT_SPACE).hashes()
    line = np.repeat(np.arange(n), count)
    fresh = _first_of_row(line, hashes)
    # A word is repeated where the run of words that begins with it has begun before in its text.
    prefix = tx.sequence_prefix(hashes)
    at = np.arange(len(words))
    ends = words.rows[1:][tx.row_of(words.rows)]
    run = tx.sequence_hash(prefix, at, np.minimum(at + _SEEN, ends))
    again = ~_first_of_row(tx.row_of(words.rows), run) & (at + _SEEN <= ends)
    whole = tx.sequence_hash(prefix, first, first + count)
    capital = kinds[words.start] == 1
    # A word that equals the one before it in its line.
    twice = np.concatenate([[False], (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])])
    same = np.concatenate([[False], (data[1:] == data[:-1]) & (kinds[1:] >= 4)])
    doubled = np.concatenate([[0], np.cumsum(same)])
    values = np.column_stack([
        np.log1p(size), np.log1p(count), (size - share[:, 3]) / count, share[:, 1] / size, share[:, 2] / size, share[:, 3] / size,
        share[:, 4] / size, share[:, 5] / size, word_sum(capital) / count, word_sum(fresh) / count, word_sum(again) / count, word_sum(twice) / count,
        ~_first_of_row(row, whole), _ENDS[data[words.stop[first + count - 1] - 1]], (doubled[stop] - doubled[start]) / size])
    return Lines(np.searchsorted(row, np.arange(len(offsets))), leads[stop] - leads[start], values)


def binned(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Bin of each value: the number of edges of its feature that lie below it."""
    return np.stack([np.searchsorted(edges[k], values[:, k], "left") for k in range(values.shape[1])], axis=1)


def neighbours(bins: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Weight numbers per line: own bins, those of the line before and of the line after; a missing one has its own bin."""
    size = BINS + 1  # the last bin is that of a missing neighbour
    wide = bins.shape[1] * size
    base = np.arange(bins.shape[1]) * size
    before, after = np.full_like(bins, BINS), np.full_like(bins, BINS)
    before[1:], after[:-1] = bins[:-1], bins[1:]
    heads, tails = rows[:-1][np.diff(rows) > 0], rows[1:][np.diff(rows) > 0] - 1
    before[heads], after[tails] = BINS, BINS
    return np.concatenate([bins + base, before + base + wide, after + base + 2 * wide], axis=1)


# -------------------------------------------------------------------------------------------- chain

def _products(steps: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For each position the product of its 2 x 2 matrix and all before it in its chain, scaled to a largest entry of 1.

    ``place`` is the position in the chain. Doubling: after k rounds a product covers 2^k positions.
    """
    out, reach = steps.copy(), 1
    longest = int(place.max(initial=0))
    while reach <= longest:
        at = np.flatnonzero(place >= reach)
        joined = np.einsum("nij,njk->nik", out[at - reach], out[at])
        out[at] = joined / joined.max(axis=(1, 2), keepdims=True)
        reach *= 2
    return out


def marginals(score: np.ndarray, transition: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of good per line, and of each pair of labels of a line and the line before it.

    ``score`` is the log-odds of good from a line's features, ``transition[a, b]`` the score of label b
    after label a (0 bad, 1 good). The pair table of a first line is zero.
    """
    n = len(score)
    if not n:
        return np.zeros(0), np.zeros((0, 2, 2))
    place = np.arange(n) - np.repeat(rows[:-1], np.diff(rows))
    behind = np.repeat(rows[1:], np.diff(rows)) - 1 - np.arange(n)
    clipped = np.clip(score, -60, 60)
    node = np.stack([np.exp(-np.maximum(clipped, 0)), np.exp(np.minimum(clipped, 0))], axis=1)
    table = np.exp(transition - transition.max())
    step = table[None] * node[:, None, :]
    # At the first line all ways start alike; rows of its matrix are equal.
    step[place == 0] = node[place == 0][:, None, :]
    step /= step.max(axis=(1, 2), keepdims=True)
    forward = _products(step, place)[:, 0, :]
    # Backward: the matrices of the following lines, in reverse order and transposed.
    turned = np.empty_like(step)
    turned[:-1] = step[1:]
    turned[behind == 0] = 1.0
    mirrored = np.ascontiguousarray(np.swapaxes(turned[::-1], 1, 2))
    backward = _products(mirrored, behind[::-1])[::-1][:, 0, :]
    both = forward * backward
    good = both[:, 1] / both.sum(axis=1)
    pair = np.zeros((n, 2, 2))
    inner = np.flatnonzero(place > 0)
    raw = forward[inner - 1][:, :, None] * table[None] * (node * backward)[inner][:, None, :]
    pair[inner] = raw / raw.sum(axis=(1, 2), keepdims=True)
    return good, pair


@dataclass
class Model:
    """Bin edges per feature, weights of good per (side, feature, bin), transitions, and the map to a probability."""

    edges: np.ndarray
    weights: np.ndarray
    transition: np.ndarray
    calibration: tuple[float, float]
    prior: float

    def good(self, lines: Lines) -> np.ndarray:
        index = neighbours(binned(lines.values, self.edges), lines.rows)
        return marginals(self.weights[index].sum(axis=1), self.transition, lines.rows)[0]

    def share(self, lines: Lines, good: np.ndarray) -> np.ndarray:
        """Good characters of all characters per row; NaN without a line."""
        total = np.concatenate([[0.0], np.cumsum(lines.chars * good)])
        chars = np.concatenate([[0], np.cumsum(lines.chars)])
        with np.errstate(invalid="ignore", divide="ignore"):
            return (total[lines.rows[1:]] - total[lines.rows[:-1]]) / (chars[lines.rows[1:]] - chars[lines.rows[:-1]])

    def probability(self, share: np.ndarray) -> np.ndarray:
        odds = np.log((share + 1e-3) / (1 - share + 1e-3))
        p = 1 / (1 + np.exp(-np.clip(self.calibration[0] + self.calibration[1] * odds, -30, 30)))
        return np.where(np.isnan(share), self.prior, p)


def _gradient(weights, transition, index, rows, label):
    """Gradient of the mean log likelihood per line in the weights and transitions."""
    good, pair = marginals(weights[index].sum(axis=1), transition, rows)
    n = len(label)
    slope = np.bincount(index.ravel(), np.repeat(label - good, index.shape[1]), len(weights)) / n
    inner = np.flatnonzero(np.arange(n) > np.repeat(rows[:-1], np.diff(rows)))
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[inner - 1].astype(int), label[inner].astype(int)), 1)
    return slope - RIDGE * weights, (seen - pair.sum(axis=0)) / n - RIDGE * transition


def train(values: np.ndarray, rows: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges, weights and transitions for lines with values, in chains ``rows``, with a label per line."""
    edges = np.quantile(values, np.arange(1, BINS) / BINS, axis=0).T if len(values) else np.zeros((len(FEATURES), BINS - 1))
    index = neighbours(binned(values, edges), rows)
    parts = [np.zeros(3 * values.shape[1] * (BINS + 1)), np.zeros((2, 2))]
    first, second = ([np.zeros_like(p) for p in parts] for _ in range(2))
    for step in range(1, ROUNDS + 1):
        for k, g in enumerate(_gradient(parts[0], parts[1], index, rows, label)):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            parts[k] = parts[k] + RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return edges, *parts


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope; a little ridge keeps separable data finite."""
    w, wide = np.zeros(2), np.column_stack([np.ones(len(x)), x])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(wide @ w, -30, 30)))
        ridge = np.diag([1e-3, 1e-1])
        step = np.linalg.solve((wide * (p * (1 - p))[:, None]).T @ wide + ridge, wide.T @ (y - p) - ridge @ w)
        w = w + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


# -------------------------------------------------------------------------------------------- Spark

_SAMPLED = "fold long, label long, chars array<long>, values array<double>"


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(text, label, fold)`` to the values of the first ``SAMPLE_LINES`` lines of each text."""
    for batch in tx.pieces(batches, "text"):
        lines = measure(*tx.utf8(batch["text"]))
        ends = np.minimum(lines.rows[1:], lines.rows[:-1] + SAMPLE_LINES)
        chars = [lines.chars[a:b].tolist() for a, b in zip(lines.rows[:-1], ends)]
        values = [lines.values[a:b].ravel().tolist() for a, b in zip(lines.rows[:-1], ends)]
        yield pa.RecordBatch.from_arrays(
            [batch["fold"], batch["label"], pa.array(chars, pa.list_(pa.int64())), pa.array(values, pa.list_(pa.float64()))],
            ["fold", "label", "chars", "values"])


def _joined(rows: list) -> tuple[Lines, np.ndarray]:
    counts = np.array([len(r["chars"]) for r in rows], np.int64)
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    values = np.concatenate([np.zeros((0, len(FEATURES))), *(np.array(r["values"]).reshape(-1, len(FEATURES)) for r in rows)])
    chars = np.concatenate([np.zeros(0, np.int64), *(np.array(r["chars"], np.int64) for r in rows)])
    return Lines(ends, chars, values), np.array([float(r["label"] == 1) for r in rows])


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> Model:
    """A model from ``docs (doc_id, text)`` and ``labels (doc_id, label)``, 1 for good.

    Null ids, labels and texts are left out. An id, and equal texts, with both labels count as good. The
    sample is drawn by hash of the id. Without labelled lines of both kinds every score is the share of
    good labels (one half without any).
    """
    session_of(docs)
    draw = F.xxhash64(F.col("doc_id"), F.lit("quality"))
    picked = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(
        F.max(F.col("label").cast("long")).alias("label")).orderBy(draw, "doc_id").limit(sample)
    # The sample is bounded by its size, so it may be broadcast; documents are not shuffled.
    rows = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy("text").agg(
        F.max("label").alias("label"), F.min("doc_id").alias("doc_id"))
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(4)).alias("fold")
    drawn = materialize(rows.select("text", "label", fold).mapInArrow(_sampled, _SAMPLED), "lines").collect()
    drawn.sort(key=lambda r: (r["fold"], r["label"], r["chars"], r["values"]))  # the order of arrival must not matter
    learn, check = ([r for r in drawn if (r["fold"] == 0) == held and r["chars"]] for held in (False, True))
    lines, label = _joined(learn)
    share = (sum(r["label"] == 1 for r in drawn) + 0.5) / (len(drawn) + 1)
    blank = Model(np.zeros((len(FEATURES), BINS - 1)), np.zeros(3 * len(FEATURES) * (BINS + 1)), np.zeros((2, 2)),
                  (math.log(share / (1 - share)), 0.0), share)
    if len(set(label.tolist())) < 2:
        return blank
    model = Model(*train(lines.values, lines.rows, np.repeat(label, np.diff(lines.rows))), (0.0, 1.0), share)
    tested, truth = _joined(check if len({r["label"] == 1 for r in check}) == 2 else learn)
    shares = model.share(tested, model.good(tested))
    model.calibration = _logistic(np.log((shares + 1e-3) / (1 - shares + 1e-3)), truth)
    return model


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.pieces(batches, "text"):
            lines = measure(*tx.utf8(batch["text"]))
            good = model.good(lines)
            share = model.share(lines, good)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(np.diff(lines.rows)), tx.lists(pa.array(good), np.diff(lines.rows)),
                 pa.array(share, mask=np.isnan(share)), pa.array(model.probability(share))],
                ["doc_id", "n_lines", "good", "share", "score"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, n_lines, good, share, score`` per row of ``docs``.

    ``good`` holds the marginal of each line that is not blank, in order, ``share`` their mean by
    characters, ``score`` the probability that the document is good. Null, empty and blank texts have no
    lines, a null share and the sample's share of good documents as score. Null ids, repeated ids and
    repeated rows each give a row; other columns are not read; an empty table gives no rows.
    """
    session_of(docs)
    return docs.select("doc_id", "text").mapInArrow(
        _score(model), "doc_id long, n_lines long, good array<double>, share double, score double")
