"""Operators on words and bytes against brute force on small tables."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from millrace.llm import contamination, debruijn, minhash, suffix
from millrace.llm.frames import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED, ALNUM = r"[^\x20\x09-\x0D]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Clashing names: columns that the operators use inside.
DDL = "doc_id long, text string, id long, t string, h string, s string, n string, kept string, text_hash string, wanted string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "t", "h", "s", "n", "k", "x", "w") for i, t in rows], DDL)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    vocabulary = [f"w{i}é"[: rng.randint(2, 6)] for i in range(60)]
    sentence = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, passage = sentence(120), sentence(50)
    near = base.split()
    near[60] = "changed"
    rows = [
        (1, None), (2, ""), (3, "   \n"), (4, "one"), (5, "One two three"), (6, base), (7, base), (8, " ".join(near)),
        (9, sentence(30) + " " + passage + " " + sentence(40)), (10, sentence(25) + " " + passage), (10, passage),
        (None, base), (None, sentence(20)), (11, "ab " * 300), (12, sentence(30) + " " + "ab " * 90), (13, "a" * 900), (14, "a" * 500),
        (15, sentence(2500)), (16, "ONE"), (17, "x" + "é世" * 150), (18, "y" + "é世" * 150)]
    return rows + [(100 + i, base.replace(" ", "  ", i)) for i in range(5)] + [(200, passage + f" end{i}") for i in range(2)]


def brute_windows(sequences, size):
    counts = Counter(tuple(s[k:k + size]) for s in sequences for k in range(len(s) - size + 1))
    out = []
    for s in sequences:
        gone = [False] * len(s)
        for k in range(len(s) - size + 1):
            if counts[tuple(s[k:k + size])] > 1:
                gone[k:k + size] = [True] * size
        out.append(gone)
    return out


def test_word_runs(spark, corpus):
    words = [re.findall(SPACED, t or "") for _, t in corpus]
    want = Counter((i, len(w), " ".join(x for x, g in zip(w, gone) if not g)) for (i, _), w, gone in zip(corpus, words, brute_windows(words, 35)))
    got = debruijn.remove_repeats(docs_of(spark, corpus)).collect()
    assert Counter((r["doc_id"], r["n_words"], r["kept"]) for r in got) == want


def test_paths_are_maximal_around_branches(spark):
    left, right, middle = ([f"{c}{i}" for i in range(30)] for c in "lrm")
    texts = [" ".join(left + middle + ["x"] * 3), " ".join(left + middle + right), " ".join(["y"] * 3 + middle + right)]
    rows = docs_of(spark, list(enumerate(texts)))
    paths, _ = debruijn.paths_and_spans(rows, 10)
    assert all(r["copies"] >= 2 and r["hi"] > r["lo"] for r in paths.collect())


def test_byte_runs(spark, corpus):
    data = [(t or "").encode() for _, t in corpus]
    want = Counter((i, len(b), bytes(x for x, g in zip(b, gone) if not g)) for (i, _), b, gone in zip(corpus, data, brute_windows(data, 200)))
    got = suffix.remove_repeats(docs_of(spark, corpus)).collect()
    assert Counter((r["doc_id"], r["n_bytes"], bytes(r["kept"])) for r in got) == want


def test_crowded_anchors_take_the_counting_way(spark, corpus, monkeypatch):
    monkeypatch.setattr(suffix, "GROUP_SEGMENTS", 1)
    data = [(t or "").encode() for _, t in corpus]
    want = Counter((i, bytes(x for x, g in zip(b, gone) if not g)) for (i, _), b, gone in zip(corpus, data, brute_windows(data, 200)))
    got = suffix.remove_repeats(docs_of(spark, corpus)).collect()
    assert Counter((r["doc_id"], bytes(r["kept"])) for r in got) == want


@pytest.mark.parametrize("seed", range(6))
def test_suffix_order(seed):
    rng = np.random.default_rng(seed)
    data = rng.integers(97, 97 + 1 + seed, 400).astype(np.uint8)
    wanted = rng.random(400) < 0.6
    blob = data.tobytes()
    order = suffix.suffix_order(data, wanted, 400)
    assert order.tolist() == sorted(np.flatnonzero(wanted).tolist(), key=lambda i: blob[i:])


def shingles(text):
    w = re.findall(SPACED, (text or "").translate(LOWER))
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    """Components over ids; rows of one id are one node, and a null id links with nothing."""
    ids = sorted({i for i, _ in rows if i is not None})
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: root(i) for i in ids}


def test_near_duplicates(spark, corpus):
    unique = [r for k, r in enumerate(corpus) if r[0] is None or r[0] not in {i for i, _ in corpus[:k]}]
    want = brute_components(unique)
    got = minhash.near_duplicates(docs_of(spark, unique)).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got) == Counter(
        (i, len(shingles(t)), None if i is None else want[i], None if i is None else want[i] == i) for i, t in unique)


def test_groups_of_several_chunks(spark, monkeypatch):
    rng = random.Random(2)
    base = [f"v{rng.randint(0, 500)}" for _ in range(300)]
    rows = []
    for i in range(40):
        words = list(base)
        for _ in range(i % 9):
            words[rng.randrange(300)] = f"n{i}"
        rows.append((i, " ".join(words)))
    monkeypatch.setattr(minhash, "CHUNK_SHINGLES", 2000)
    want = brute_components(rows)
    assert {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs_of(spark, rows)).collect()} == want


def test_one_per_group_keeps_columns_and_null_ids(spark, corpus):
    rows = docs_of(spark, corpus + [(6, corpus[5][1])])
    kept = minhash.one_per_group(rows)
    assert kept.columns == rows.columns
    ids = [r["doc_id"] for r in kept.collect()]
    named = [i for i in ids if i is not None]
    assert len(named) == len(set(named)) and ids.count(None) == 2
    assert 6 in named and 7 not in named and 8 not in named and {2, 3, 4, 5, 11, 15} <= set(named)


def test_sketches_estimate_similarity_and_fill():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 400, dtype=np.uint64)
    sets = [np.unique(pool[:300]), np.unique(pool[60:360]), pool[:1], pool[:0]]
    rows = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    got = minhash.sketch(np.concatenate(sets), rows, 128)
    full = ~np.uint64(0)
    assert (got[:3] != full).all() and (got[3] == full).all()
    assert abs((got[0] == got[1]).mean() - 240 / 360) < 0.15


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7), (None, 3)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(chain).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def brute_hits(rows, items, size=10):
    windows = {}
    for item, text in items:
        w = re.findall(ALNUM, (text or "").translate(LOWER))
        for k in range(max(len(w) - size, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[k:k + size]), set()).add(item)
    out = []
    for i, text in rows:
        w, hit, found = re.findall(ALNUM, (text or "").translate(LOWER)), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        out.append((i, len(w), len(hit), tuple(sorted(found))))
    return Counter(out)


@pytest.mark.parametrize("block", [100_000, 7])
def test_contamination(spark, corpus, block):
    passage = corpus[10][1]
    items = [(1, passage), (2, "One, TWO three"), (3, None), (4, ""), (5, "ab " * 12), (6, passage), (9, "never seen words at all"), (9, "one")]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, words string")
    got = contamination.contaminated(docs_of(spark, corpus), bench, block_windows=block).collect()
    assert Counter((r["doc_id"], r["n_words"], sum(x["stop"] - x["start"] for x in r["hits"]), tuple(r["items"])) for r in got) == brute_hits(corpus, items)
    clean = contamination.without_contaminated(docs_of(spark, corpus), bench, block_windows=block)
    want = sum(n for (_, _, hit, _), n in brute_hits(corpus, items).items() if not hit)
    assert clean.count() == want and len(clean.columns) == 10


def test_empty_tables(spark):
    docs = docs_of(spark, [])
    bench = spark.createDataFrame([], "item_id long, text string")
    assert debruijn.remove_repeats(docs).count() == 0
    assert suffix.remove_repeats(docs).count() == 0
    assert minhash.near_duplicates(docs).count() == 0
    assert minhash.one_per_group(docs).count() == 0
    assert contamination.contaminated(docs, bench).count() == 0
    assert contamination.contaminated(docs_of(spark, [(1, "a b")]), bench).collect()[0]["n_words"] == 2


def test_digest_of_nothing_is_that_of_the_empty_string(spark):
    from pyspark.sql import functions as F

    row = contamination.contaminated(docs_of(spark, [(1, None)]), spark.createDataFrame([(1, "a")], "item_id long, text string")).select(
        F.sha2(F.array_join(F.array_sort(F.col("items").cast("array<string>")), ","), 256).alias("x")).first()
    assert row["x"] == hashlib.sha256(b"").hexdigest()
