"""Lexical search against scoring every document for every item."""

import math
import random
import re

import numpy as np
import pytest

from millrace.llm import lexical

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, k=10):
    read = [(i, terms(t)) for i, t in docs]
    read = [(i, t) for i, t in read if t]
    total, df = sum(len(t) for _, t in read), {}
    for _, t in read:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    asked = {}
    for i, t in set(items):
        if i is not None:
            asked.setdefault(i, []).extend(terms(t))
    out = []
    for item, wanted in asked.items():
        scored = []
        for i, t in read:
            m = 25 + 75 * len(t) * len(read) // total
            score = sum(math.floor(1000 * math.log((2 * len(read) + 2) / (2 * df[w] + 1))) * (10**9 * t.count(w) // (1000 * t.count(w) + 8 * m))
                        for w in wanted if w in t)
            if score > 0:
                scored.append((-score, i is None, i if i is not None else 0, i))
        out += [(item, n + 1, x[3], -x[0]) for n, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=lambda r: r[:2])


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["é", "Ünder", "x9"]
    weights = [1 / (i + 1) for i in range(len(words))]
    text = lambda n: " ".join(rng.choices(words, weights, k=n))
    docs = [(i, text(rng.choice([3, 5, 5, 8, 30, 200]))) for i in range(300)]
    docs += [(1000 + i, docs[7][1]) for i in range(40)]  # many equal scores
    docs += [(None, docs[7][1]), (3, docs[3][1]), (5, text(6)), (2000, None), (2001, ""), (2002, "?!"), (2003, "W1 " * 40_000), (2004, "only-Here")]
    items = [(i, text(rng.choice([1, 4, 12]))) for i in range(25)] + [
        (100, docs[7][1]), (101, None), (102, ""), (103, "nowhere"), (104, "onlyhere ONLY here here"), (None, "w1"), (1, "w3 w3"), (100, docs[7][1])]
    return docs, items


@pytest.mark.parametrize("block, run", [(200_000, 4_000_000), (20, 4_000_000), (200_000, 300)])
def test_ranking(spark, corpus, monkeypatch, block, run):
    docs, items = corpus
    monkeypatch.setattr(lexical, "BLOCK_TERMS", block)
    monkeypatch.setattr(lexical, "RUN_POSTINGS", run)
    table = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, score int").repartition(3)
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, rank string")
    got = lexical.search(lexical.build(table), asked)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[:2]) == brute(docs, items)


def test_other_k(spark, corpus):
    docs, items = corpus
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = lexical.search(lexical.build(table), asked, k=1)
    assert sorted(tuple(r) for r in got.collect()) == brute(docs, items, 1)


def test_strata_below_the_best_are_not_visited(monkeypatch):
    """The first visit holds four times k documents; no later stratum can reach their scores."""
    rng = np.random.default_rng(1)
    n = 400
    m = np.concatenate([np.full(20, 25), 1000 + np.arange(n)])
    doc, term, tf = np.arange(n + 20), np.zeros(n + 20, np.int64), np.ones(n + 20, np.int64)
    index = lexical.Run(m, rng.permutation(n + 20), doc, term, tf, 1)
    visited = []
    plain = np.add.at
    monkeypatch.setattr(lexical.np, "add", type("Add", (), {"at": staticmethod(lambda a, i, b: (visited.append(len(i)), plain(a, i, b)))}))
    docs, scores = index.best(np.array([0]), np.array([5]), 10, 0)
    monkeypatch.undo()
    assert visited == [n + 1, 40] and len(docs) == 10 and (docs < 20).all()
    assert set(scores.tolist()) == {5 * (10**9 // (1000 + 8 * 25))}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(lexical.build(docs.limit(0)), items).collect() == []
    assert lexical.search(lexical.build(docs), items.limit(0)).collect() == []
