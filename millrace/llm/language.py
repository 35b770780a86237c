"""Language identification by a byte convolutional network trained here in numpy.

Network: byte embedding, filters of several widths, rectifier, max pooling over a window of ``WINDOW``
bytes, softmax. It is trained with Adam on at most about ``PER_LANGUAGE`` documents of each language
(a random subset by hash of the id), ``WINDOWS`` windows from each.

A text is cut into consecutive windows, the last one padded, so all of it counts; its languages get the
mean of the window probabilities. For scoring the embedding and the filters are folded into tables over
byte pairs, so a window costs a few lookups per byte, and batches are many windows at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm import text as tx
from millrace.llm.frames import session_of

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
EMBEDDING = 8
PER_LANGUAGE, WINDOWS = 1500, 4
EPOCHS, BATCH, RATE = 6, 128, 0.01
PIECE_BYTES = 500_000
UNKNOWN = "und"

_FEATURES = FILTERS * len(WIDTHS)


@dataclass
class Model:
    languages: list[str]
    first: np.ndarray   # byte pair -> part of every filter
    third: np.ndarray   # third byte -> filters of width 3
    last: np.ndarray    # second byte pair -> filters of width 4
    bias: np.ndarray
    dense: np.ndarray
    out: np.ndarray

    def features(self, windows: np.ndarray) -> np.ndarray:
        """Pooled features of ``(n, WINDOW)`` bytes."""
        wide = np.zeros((len(windows), windows.shape[1] + 3), np.uint8)
        wide[:, : windows.shape[1]] = windows
        pairs = (wide[:, :-1].astype(np.int32) << 8) | wide[:, 1:]
        size = windows.shape[1]
        hidden = self.first[pairs[:, :size]]
        hidden[:, :, FILTERS: 2 * FILTERS] += self.third[wide[:, 2: size + 2]]
        hidden[:, :, 2 * FILTERS:] += self.last[pairs[:, 2: size + 2]]
        return np.maximum(hidden.max(axis=1) + self.bias, 0)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        logits = self.features(windows) @ self.dense + self.out
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def cut_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Consecutive windows of all rows, zero padded, and the number per row (none for an empty row)."""
    count = -(-np.diff(offsets) // WINDOW)
    start = np.repeat(offsets[:-1], count) + WINDOW * tx.ranges(np.zeros(len(count), np.int64), count)
    index = start[:, None] + np.arange(WINDOW)
    inside = index < np.repeat(offsets[1:], count)[:, None]
    padded = np.append(data, np.uint8(0))
    return np.where(inside, padded[np.minimum(index, len(data))], 0).astype(np.uint8), count


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str]) -> Model:
    """The network after ``EPOCHS`` passes over the windows."""
    rng = np.random.default_rng(7)
    classes = len(languages)
    p = {"embed": rng.normal(0, 0.5, (256, EMBEDDING)), "dense": rng.normal(0, 0.2, (_FEATURES, classes)),
         "out": np.zeros(classes), "bias": np.zeros(_FEATURES)}
    for w in WIDTHS:
        p[f"f{w}"] = rng.normal(0, 1 / np.sqrt(w * EMBEDDING), (w * EMBEDDING, FILTERS))
    p = {k: v.astype(np.float32) for k, v in p.items()}
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for low in range(0, len(order), BATCH):
            x, y = windows[order[low: low + BATCH]], labels[order[low: low + BATCH]]
            n, rows = len(x), np.arange(len(x))[:, None]
            x = np.concatenate([x, np.zeros((n, 3), np.uint8)], axis=1)
            e = p["embed"][x]
            pooled, where = [], []
            for w in WIDTHS:
                wide = np.concatenate([e[:, i: i + WINDOW] for i in range(w)], axis=2)
                h = wide @ p[f"f{w}"]
                at = h.argmax(axis=1)
                where.append(at)
                pooled.append(np.take_along_axis(h, at[:, None, :], 1)[:, 0])
            raw = np.concatenate(pooled, axis=1) + p["bias"]
            act = np.maximum(raw, 0)
            logits = act @ p["dense"] + p["out"]
            q = np.exp(logits - logits.max(axis=1, keepdims=True))
            q /= q.sum(axis=1, keepdims=True)
            q[np.arange(n), y] -= 1
            q /= n
            g = {"dense": act.T @ q, "out": q.sum(axis=0), "embed": np.zeros_like(p["embed"])}
            d = (q @ p["dense"].T) * (raw > 0)
            g["bias"] = d.sum(axis=0)
            # Only the winning position of each filter passes its gradient on.
            for k, w in enumerate(WIDTHS):
                dw, at = d[:, k * FILTERS: (k + 1) * FILTERS], where[k]
                taken = x[rows[:, :, None], at[:, :, None] + np.arange(w)]
                patch = p["embed"][taken].reshape(n, FILTERS, w * EMBEDDING)
                g[f"f{w}"] = np.einsum("nfk,nf->kf", patch, dw)
                back = dw[:, :, None] * p[f"f{w}"].T[None]
                np.add.at(g["embed"], taken.reshape(-1), back.reshape(-1, EMBEDDING))
            step += 1
            for k in p:
                first[k] = 0.9 * first[k] + 0.1 * g[k]
                second[k] = 0.999 * second[k] + 0.001 * g[k] ** 2
                p[k] -= RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return fold(p, languages)


def fold(p: dict[str, np.ndarray], languages: list[str]) -> Model:
    """The network as sums over tables: embedding and filters ``f2, f3, f4`` are applied to byte pairs beforehand."""
    tap = lambda w, i: (p["embed"] @ p[f"f{w}"][i * EMBEDDING: (i + 1) * EMBEDDING]).astype(np.float32)
    pair = lambda w, i: (tap(w, i)[:, None, :] + tap(w, i + 1)[None]).reshape(65536, FILTERS)
    return Model(languages, np.concatenate([pair(2, 0), pair(3, 0), pair(4, 0)], axis=1), tap(3, 2), pair(4, 2),
                 p["bias"], p["dense"], p["out"])


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(lang, text)`` to up to ``WINDOWS`` windows per text, spread over all of it."""
    for batch in tx.pieces(batches, "text", PIECE_BYTES):
        windows, count = cut_windows(*tx.utf8(batch["text"]))
        number = np.minimum(count, WINDOWS)
        first = np.concatenate([[0], np.cumsum(count)])[:-1]
        row = np.repeat(np.arange(len(count)), number)
        turn = tx.ranges(np.zeros(len(count), np.int64), number)
        at = first[row] + turn * count[row] // np.maximum(number[row], 1)
        yield pa.RecordBatch.from_arrays(
            [batch["lang"].take(pa.array(row)), pa.array([w.tobytes() for w in windows[at]], pa.binary())], ["lang", "window"])


def fit(docs: DataFrame, *, per_language: int = PER_LANGUAGE) -> Model:
    """A model from the texts and languages of ``docs (doc_id, text, lang)``; null languages and texts are left out.

    The sample holds about ``per_language`` documents a language, drawn by a hash of id and text.
    """
    session_of(docs)
    known = docs.where("lang is not null and text is not null").select("doc_id", "lang", "text")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if len(languages) < 2:
        empty = np.zeros
        return Model(languages or [UNKNOWN], empty((65536, _FEATURES), np.float32), empty((256, FILTERS), np.float32),
                     empty((65536, FILTERS), np.float32), empty(_FEATURES), empty((_FEATURES, 1)), empty(1))
    # A hash of id and text spreads null and repeated ids too; repeated rows count once.
    draw = F.xxhash64("doc_id", "text", F.lit("language"))
    bound = {k: int(2.0 ** 64 * min(1.0, per_language / n)) - 2 ** 63 for k, n in sizes.items()}
    share = F.create_map(*(c for k, b in bound.items() for c in (F.lit(k), F.lit(min(b, 2 ** 63 - 1)).cast("long"))))
    picked = known.where(draw <= share[F.col("lang")]).dropDuplicates().select("lang", "text").mapInArrow(_spread, "lang string, window binary").collect()
    rows = sorted((r["lang"], bytes(r["window"])) for r in picked)  # the order of arrival must not matter
    windows = np.frombuffer(b"".join(w for _, w in rows), np.uint8).reshape(-1, WINDOW)
    place = {k: i for i, k in enumerate(languages)}
    return train(windows, np.array([place[lang] for lang, _ in rows]), languages)


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.pieces(batches, "text", PIECE_BYTES):
            windows, count = cut_windows(*tx.utf8(batch["text"]))
            parts = [model.probabilities(windows[k: k + 64]) for k in range(0, len(windows), 64)]
            sums = np.concatenate([np.zeros((1, len(model.languages))), np.cumsum(np.concatenate(parts), axis=0)]) if parts else np.zeros((1, len(model.languages)))
            rows = np.concatenate([[0], np.cumsum(count)])
            mean = (sums[rows[1:]] - sums[rows[:-1]]) / np.maximum(count, 1)[:, None]
            best = mean.argmax(axis=1)
            spoken = batch["spoken"].to_numpy(zero_copy_only=False).astype(bool)
            names = [model.languages[b] if s else UNKNOWN for b, s in zip(best, spoken)]
            score = np.where(spoken, np.clip(mean[np.arange(len(best)), best], 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score`` per row of ``docs``; ``und`` with score 0 for null texts and texts without a letter.

    Null ids, repeated ids and repeated rows each give a row; other columns are not read; an empty table
    gives no rows.
    """
    session_of(docs)
    spoken = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select("doc_id", "text", spoken.alias("spoken")).mapInArrow(_predict(model), "doc_id long, lang_pred string, score double")
