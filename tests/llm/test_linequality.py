"""The line chain against sums over all label sequences, its gradient, and held-out accuracy."""

import itertools
import random

import numpy as np
import pytest

from millrace.llm import linequality as lq
from millrace.llm import text as tx

import pyarrow as pa


def measured(*texts):
    return lq.measure(*tx.utf8(pa.array(texts, pa.string())))


def every_sequence(score, transition):
    """Marginals by adding up all label sequences of one chain."""
    n = len(score)
    total, good, pair = 0.0, np.zeros(n), np.zeros((n, 2, 2))
    for labels in itertools.product((0, 1), repeat=n):
        x = sum(s for s, y in zip(score, labels) if y) + sum(transition[a, b] for a, b in zip(labels, labels[1:]))
        weight = np.exp(x)
        total += weight
        for t, y in enumerate(labels):
            good[t] += weight * y
            if t:
                pair[t, labels[t - 1], y] += weight
    return good / total, pair / total


@pytest.mark.parametrize("seed", range(5))
def test_marginals(seed):
    rng = np.random.default_rng(seed)
    sizes = [0, 1, 5, 0, 8, 2, 3]
    rows = np.concatenate([[0], np.cumsum(sizes)])
    score, transition = rng.normal(0, 2, rows[-1]), rng.normal(0, 1.5, (2, 2))
    good, pair = lq.marginals(score, transition, rows)
    for a, b in zip(rows[:-1], rows[1:]):
        if b > a:
            one, two = every_sequence(score[a:b], transition)
            assert np.allclose(good[a:b], one) and np.allclose(pair[a:b], two)


def test_marginals_of_a_long_chain_stay_finite():
    rng = np.random.default_rng(1)
    good, pair = lq.marginals(rng.normal(0, 30, 100_001), np.array([[3.0, -4.0], [-4.0, 3.0]]), np.array([0, 1, 100_001]))
    assert np.isfinite(good).all() and np.isfinite(pair).all() and np.allclose(pair[2:].sum(axis=(1, 2)), 1)
    assert np.allclose(pair[2:, :, 1].sum(axis=1), good[2:])


def test_gradient_is_that_of_the_likelihood(monkeypatch):
    monkeypatch.setattr(lq, "RIDGE", 0.0)
    rng = np.random.default_rng(2)
    rows, size = np.array([0, 4, 4, 7, 8]), 6
    index, label = rng.integers(0, size, (8, 3)), rng.integers(0, 2, 8).astype(float)
    weights, transition = rng.normal(size=size), rng.normal(size=(2, 2))

    def likelihood(w, t):
        score, value = w[index].sum(axis=1), 0.0
        for a, b in zip(rows[:-1], rows[1:]):
            way = lambda y: sum(s for s, k in zip(score[a:b], y) if k) + sum(t[int(p), int(q)] for p, q in zip(y, y[1:]))  # noqa: E731, B023
            if b > a:
                value += way(label[a:b]) - np.log(sum(np.exp(way(y)) for y in itertools.product((0, 1), repeat=b - a)))
        return value / len(label)

    slope, moves = lq._gradient(weights, transition, index, rows, label)
    for k in range(size):
        step = np.eye(size)[k] * 1e-6
        assert slope[k] == pytest.approx((likelihood(weights + step, transition) - likelihood(weights - step, transition)) / 2e-6, abs=1e-6)
    for k in range(4):
        step = np.eye(4)[k].reshape(2, 2) * 1e-6
        assert moves.ravel()[k] == pytest.approx((likelihood(weights, transition + step) - likelihood(weights, transition - step)) / 2e-6, abs=1e-6)


def test_lines_and_values():
    lines = measured("One two.\n\n \nabc ABC 12\r\nOne two.", None, "", " \n", "é é", "a b c d x a b c d\n")
    assert lines.rows.tolist() == [0, 3, 3, 3, 3, 4, 5]
    assert lines.chars.tolist() == [9, 12, 8, 3, 18]
    at = {name: lines.values[:, k].tolist() for k, name in enumerate(lq.FEATURES)}
    assert at["seen"] == [0, 0, 1, 0, 0] and at["ended"] == [1, 0, 1, 0, 0]
    assert at["distinct"] == [1, 2 / 3, 1, 0.5, 5 / 9] and at["repeated"][-1] == pytest.approx(1 / 9)
    assert at["digits"][1] == pytest.approx(2 / 12) and at["upper"][1] == pytest.approx(3 / 12)
    assert np.allclose(at["words"], np.log1p([2, 3, 2, 2, 9]))


def test_texts_do_not_depend_on_their_batch():
    texts = ["One two three.\nFour | five | six", "x y z\nx y z\nx y z", "", "Last one, here."]
    together = measured(*texts)
    for k, text in enumerate(texts):
        alone = measured(text)
        assert np.array_equal(together.values[together.rows[k]: together.rows[k + 1]], alone.values)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    prose = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(6, 14))).capitalize() + "."
    junk = lambda: " | ".join(rng.choice(words) for _ in range(rng.randint(3, 9)))
    rows, labels = [], []
    for i in range(900):
        bad = i % 4 == 0
        lines = [(junk if bad and k else prose)() for k in range(rng.randint(2, 12))]
        rows.append((i, "\n".join(lines), "s"))
        labels.append((i, int(not bad)))
    rows += [(None, "Some text.", "s"), (900, None, "s"), (901, "", "s"), (902, " \n ", "s"), (1, rows[1][1], "s"),
             (903, "word | word | word\n" * 30_000, "s"), (904, rows[4][1], "s")]
    labels += [(904, 1), (None, 0), (5, None)]
    return (spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(3),
            spark.createDataFrame(labels, "doc_id long, label int"))


def test_held_out_documents(corpus):
    docs, labels = corpus
    model = lq.fit(docs, labels.where("doc_id % 5 != 0 or doc_id is null"))
    rows = lq.score(docs, model).collect()
    assert len(rows) == 907
    by_id = {r["doc_id"]: r for r in rows}
    held = [i for i in range(0, 900, 5) if i not in (4,)]
    assert sum((by_id[i]["score"] >= 0.3) == (i % 4 != 0) for i in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows) and by_id[903]["n_lines"] == 30_000
    assert len({by_id[i]["score"] for i in (900, 901, 902)}) == 1 and by_id[900]["share"] is None
    for r in rows:
        assert len(r["good"]) == r["n_lines"]
    # The first line of a bad document is prose; the lines after it are not.
    assert np.mean([by_id[i]["good"][-1] < 0.5 for i in held if i % 4 == 0]) > 0.95
    again = lq.fit(docs.repartition(2), labels.where("doc_id % 5 != 0 or doc_id is null"))
    assert np.array_equal(again.weights, model.weights) and again.calibration == model.calibration


def test_without_rows_or_labels(spark, corpus):
    docs, labels = corpus
    half = lq.fit(docs, labels.limit(0))
    assert {r["score"] for r in lq.score(docs.limit(20), half).collect()} == {0.5}
    ones = lq.fit(docs, labels.where("label = 1 and doc_id < 50"))
    assert {r["score"] > 0.9 for r in lq.score(docs.limit(20), ones).collect()} == {True}
    assert lq.score(docs.limit(0), half).count() == 0
    assert lq.fit(docs.limit(0), labels).prior == 0.5
