"""The pipeline against a plain version of its stages."""

import re
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from millrace.llm import pii, toxicity  # noqa: E402
from millrace.llm.queries import QUERIES, toxicity_labels  # noqa: E402

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])


def test_run_equals_the_plain_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.fit(docs, toxicity_labels(spark, SF))
    calm = {r["doc_id"] for r in toxicity.score(docs, model).where("score < 0.3").collect()}
    rows = {r["doc_id"]: r for r in docs.collect() if r["doc_id"] in calm}
    sets = {i: shingles(r["text"]) for i, r in rows.items()}
    group = {i: i for i in rows}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                group[b] = a
    kept = {i for i in rows if root(i) == i}
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(LOWER))
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r["text"])
        windows |= {tuple(w[k:k + 10]) for k in range(max(len(w) - 10, 0) + 1)} if w else set()
    sizes = {len(w) for w in windows}
    clean = {i for i in kept if not any(tuple(w[k:k + n]) in windows for w in [words(rows[i]["text"])] for n in sizes for k in range(len(w) - n + 1))}
    assert len(clean) < len(kept) < len(calm) <= docs.count()

    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == clean

    left = docs.where(F.col("doc_id").isin(list(clean)))
    spans = {r["doc_id"]: r for r in pii.find(left, pii.fit(left)).collect()}
    total = Counter()
    for i, r in spans.items():
        text, parts, at = r["text"], [], 0
        for kind, start, stop in sorted(map(tuple, r["spans"]), key=lambda s: (s[1], s[2], s[0])):
            if start >= at:
                parts += [text[at:start], f"<{pii.KINDS[kind].upper()}>"]
            at = max(at, stop)
        size = len(re.findall(r"[^\x20\x09-\x0D]+", "".join(parts) + text[at:]))
        assert got[i]["size"] == size and got[i]["taken"] in (size, 2 * size, 0)
        total[r["source"]] += size
    assert {r["source"]: r["source_size"] for r in got.values()} == total


def test_stages_take_odd_tables(spark):
    ddl = "doc_id long, text string, lang string, source string, n_chars long, t string, spans string"
    rows = [(1, "same words " * 30, "en", "a", 1, "", ""), (2, "same words " * 30, None, None, 1, "", ""), (2, "same words " * 30, "en", "a", 1, "", ""),
            (None, "mail a@b.cd", "en", "b", 1, "", ""), (3, None, "en", "b", None, "", ""), (4, "", "en", "a", 0, "", "")]
    for data in (rows, []):
        docs = spark.createDataFrame(data, ddl)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "mixing":
                assert out.columns == docs.columns, name
            docs = out
        ids = [r["doc_id"] for r in docs.collect()]
        assert sorted(map(str, ids)) == (sorted(["1", "None", "3", "4"]) if data else [])


def test_columns_named_like_those_of_operators_keep_their_values(spark):
    names = ["spans", "base_spans", "wide_spans", "_hash", "row", "_kept_id", "_kept_hash", "node", "at"]
    rows = [(1, "mail a@b.cd now", *[f"{n} 1" for n in names]), (2, "same words " * 30, *[f"{n} 2" for n in names]),
            (3, "same words " * 30, *[f"{n} 3" for n in names])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        kept = {r["doc_id"]: tuple(r)[2:] for r in out.collect()}
        assert kept == {i: tuple(f"{n} {i}" for n in names) for i in ((1, 2) if name == "near_duplicates" else (1, 2, 3))}, name
    bare = spark.createDataFrame([(1, "mail a@b.cd now"), (2, None)], "doc_id long, text string")
    assert sorted(r["text"] or "" for r in corpus_pipeline.redact(spark, bare, SF).collect()) == ["", "mail <EMAIL> now"]
    assert corpus_pipeline.drop_near_duplicates(spark, bare, SF).count() == 2


@pytest.mark.parametrize("name", ["op4_toxicity", "op6_language_id"])
def test_scores_of_the_registered_queries(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    assert len(rows) == 200 and all(0 <= r["score"] <= 1 for r in rows) and any(r["held_out"] for r in rows)


def test_registered_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
