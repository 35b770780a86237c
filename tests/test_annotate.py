import random
import re

import numpy as np
import pytest

from millrace.operators import annotate
from millrace.operators.annotate import detect_annotations, entity_names, find_runs

TOKEN = re.compile(r"[A-Za-z]+|[0-9]+")
WORDS = ["pump", "Valve", "motor", "x", "7", "12"]


def _texts(seed, count, longest):
    rng = random.Random(seed)
    glue = ["-", " ", ", ", "\n"]
    return ["".join(rng.choice(WORDS) + rng.choice(glue) for _ in range(rng.randint(0, longest))) for _ in range(count)]


def _brute(texts, names, min_tokens):
    keys = {tuple(t.lower() for t in TOKEN.findall(n)) for n in names if n}
    keys = {k for k in keys if len(k) >= min_tokens}
    out = []
    for doc, text in enumerate(texts):
        spans = [m.span() for m in TOKEN.finditer(text or "")]
        tokens = [text[a:b].lower() for a, b in spans]
        for key in keys:
            for i in range(len(tokens) - len(key) + 1):
                if tuple(tokens[i:i + len(key)]) == key:
                    a, b = spans[i][0], spans[i + len(key) - 1][1]
                    out.append((doc, a, b, text[a:b], " ".join(key)))
    return sorted(out)


@pytest.mark.parametrize("min_tokens", [1, 2, 5])
def test_names_of_many_lengths_equal_brute_force(spark, rows, min_tokens):
    """Names that are prefixes and parts of each other, cut out of the texts; null, empty and repeated rows."""
    texts = _texts(1, 30, 40) + [None, "", "--", "pump"]
    rng = random.Random(2)
    names = ["pump", "7", None, "", "pump valve", "pump valve motor"]
    for text in texts[:30]:
        tokens = TOKEN.findall(text)
        for _ in range(3):
            i, n = rng.randrange(len(tokens) + 1), rng.randint(1, 20)
            names.append("_".join(tokens[i:i + n]).upper())
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)
    entities = spark.createDataFrame([(n,) for n in names + names[:9]], "name string")
    hits = detect_annotations(docs, entities, "name", min_tokens=min_tokens)
    assert rows(hits, "doc_id", "start", "stop", "text", "name_key") == _brute(texts, names, min_tokens)


def test_no_names_and_no_texts(spark, rows):
    docs = spark.createDataFrame([(1, "pump 7")], "doc_id int, text string")
    none = spark.createDataFrame([], "name string")
    assert rows(detect_annotations(docs, none, "name")) == []
    names = spark.createDataFrame([("pump 7",)], "name string")
    assert rows(detect_annotations(docs.where("false"), names, "name")) == []
    assert detect_annotations(docs.unionByName(docs), names, "name").count() == 2


def test_filter_bounds_and_chunks(spark):
    """Every name passes whatever the chunk size, and few runs pass that are none."""
    texts = _texts(3, 20, 60)
    tokens = [[t.lower() for t in TOKEN.findall(t)] for t in texts]
    names = [(" ".join(t[i:i + n]),) for t in tokens for i, n in [(0, 3), (2, 9), (1, 17)] if len(t) >= i + n]
    grams = entity_names(spark.createDataFrame(names, "name string"), "name").withColumnRenamed("name_key", "gram")
    filled = annotate._name_filter(grams, annotate._BITS_MIN)
    assert filled.nbytes * 8 == 1 << annotate._BITS_MIN and 0 < np.unpackbits(filled).sum() < 8 * len(names)
    keys = {tuple(n.split(" ")) for n, in names}
    want = {(d, i, n) for d, t in enumerate(tokens) for n in (3, 9, 17) for i in range(len(t) - n + 1) if tuple(t[i:i + n]) in keys}
    for size in (1, 7, 100, 1 << 16):
        found = find_runs([None, *texts, ""], (3, 9, 17), filled, size)
        got = {(d - 1, i, len(spans)) for d, hits in found.items() for i, spans in hits}
        assert all(spans[0] == [m.span() for m in TOKEN.finditer(texts[d - 1])][i] for d, hits in found.items() for i, spans in hits)
        assert want <= got and len(got - want) <= 2


def test_full_filter_changes_no_result(spark, rows, monkeypatch):
    """With a filter of few bits nearly every run passes; the join still settles what is a name."""
    monkeypatch.setattr(annotate, "_BITS_MIN", 15)
    monkeypatch.setattr(annotate, "_BITS_MAX", 15)
    monkeypatch.setattr(annotate, "_name_filter", lambda grams, bits: np.full((1 << bits) // 8, 255, np.uint8))
    texts = _texts(5, 8, 25)
    names = ["pump valve", "x 7 12", "motor-motor", "12 x", "valve 7 pump x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    hits = detect_annotations(docs, spark.createDataFrame([(n,) for n in names], "name string"), "name")
    assert rows(hits, "doc_id", "start", "stop", "text", "name_key") == _brute(texts, names, 2)


def test_folding_beyond_ascii(spark, rows):
    """Letters whose folding depends on their place or adds a mark, wide characters, letters next to numbers."""
    docs = spark.createDataFrame(
        [(1, "\U0001F600 \u039f\u0394\u039f\u03a3 12\u0130X!"), (2, "\u03bf\u03b4\u03bf\u03c2-12 i\u0307x"), (3, "\U00020000\U00020001, A\u00c5 \u216f")],
        "doc_id int, text string")
    entities = spark.createDataFrame(
        [("\u03bf\u03b4\u03bf\u03c2 12",), ("12 \u0130x",), ("\U00020000\U00020001/a\u00e5",), ("\u00e1 a",), ("A\u00c5_\u217f",)], "name string")
    hits = detect_annotations(docs, entities, "name")
    assert rows(hits, "doc_id", "start", "stop") == [(1, 2, 9), (1, 7, 11), (2, 0, 7), (3, 0, 6), (3, 4, 8)]


def test_character_tables_are_built_in_pieces():
    import tracemalloc

    from millrace.operators import annotate

    tracemalloc.start()
    annotate._characters.__wrapped__()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 << 20


def test_batches_are_cut_into_small_lists(spark, rows, monkeypatch):
    import pyarrow as pa

    from millrace.operators import annotate

    seen, plain = [], annotate.find_runs
    monkeypatch.setattr(annotate, "find_runs", lambda texts, *a: seen.append(len(texts)) or plain(texts, *a))
    every = np.full((1 << 20) // 8, 255, np.uint8)
    texts = [f"pump {i} line" if i % 3 else None for i in range(700)]
    got = annotate.token_runs([2], every).func(pa.array(texts)).to_pylist()
    assert [[r["gram"] for r in row] for row in got] == [[f"pump {i}", f"{i} line"] if i % 3 else [] for i in range(700)]
    assert max(seen) <= 256 and sum(seen) == 700
