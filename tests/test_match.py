import math
import random
from collections import Counter

import pytest

from millrace.operators.annotate import annotation_entities, detect_annotations
from millrace.operators import match
from millrace.operators.match import (
    FEATURE_TYPES, MatchModel, fit_supervised, match_pairs, match_results, name_features, predict_supervised,
)
from pyspark.sql import functions as F


def test_planted_names(frame, rows):
    sources = frame("id int, name string", (1, "23-DB-9101"), (2, "23-PC-9101"), (3, "343-Å"))
    targets = frame("id int, external_id string", (1, "IA-23_DB_9101"), (2, "VAL_23_PC_9101"))
    for kind in FEATURE_TYPES:
        pairs = match_pairs(sources, targets, MatchModel(("name",), ("external_id",), kind))
        assert rows(pairs, "source_id", "target_id") == [(1, 1), (2, 2)], kind
        results = match_results(sources, pairs)
        assert {r["source_id"]: len(r["matches"]) for r in results.collect()} == {1: 1, 2: 1, 3: 0}


def test_feature_types(frame):
    df = frame("n string", ("Pump-007 abcDef",))
    read = lambda kind: df.select(name_features(F.col("n"), kind)).first()[0]
    assert read("simple") == ["Pump", "007", "abcDef"]
    assert read("insensitive") == ["pump", "007", "abcdef"]
    assert len(read("bigram")) == 5
    assert read("bigramextratokenizers")[:4] == ["pump", "7", "abc", "def"]
    with pytest.raises(ValueError):
        name_features(F.col("n"), "fancy")


@pytest.mark.parametrize("common", [1, 12, 10_000])
@pytest.mark.parametrize("k,threshold,kind", [(1, 0.0, "insensitive"), (3, 0.0, "frequencyweightedbigram"), (2, 0.45, "bigram")])
def test_top_k_equals_brute_force(spark, rows, monkeypatch, k, threshold, kind, common):
    """Names of few, heavily shared and repeated tokens with many copies, as common or rare tokens."""
    monkeypatch.setattr(match, "_COMMON_DF", common)
    rng = random.Random(k)
    words = ["pump", "valve", "motor", "x", "7", "12"]
    name = lambda: "-".join(rng.choice(words) for _ in range(rng.randint(1, 4)))
    s = [(i, name()) for i in range(40)] + [(100 + i, "pump") for i in range(20)]
    t = [(i, name()) for i in range(40)] + [(100 + i, "pump-x") for i in range(20)]

    def features(text):
        tokens = text.split("-")
        if kind == "insensitive":
            return Counter(tokens)
        return Counter(tokens + ["\u0001".join(p) for p in zip(tokens, tokens[1:])])

    every = {tuple(sorted(features(n).elements())) for _, n in s + t}
    df = Counter(tok for f in every for tok in set(f))
    idf = (lambda tok: math.log(1 + len(every) / df[tok])) if kind.startswith("freq") else (lambda tok: 1.0)

    def unit(text):
        raw = {tok: c * idf(tok) for tok, c in features(text).items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        return {tok: v / norm for tok, v in raw.items()}

    want = []
    for sid, sn in s:
        a = unit(sn)
        scored = []
        for tid, tn in t:
            score = sum(w * unit(tn).get(tok, 0) for tok, w in a.items())
            if score > 0 and score >= threshold - 1e-9:
                scored.append((-round(score, 9), tid))
        want += [(sid, tid, rank + 1, round(-score, 5)) for rank, (score, tid) in enumerate(sorted(scored)[:k])]
    pairs = match_pairs(spark.createDataFrame(s, "id int, name string"), spark.createDataFrame(t, "id int, name string"),
                        MatchModel(("name",), ("name",), kind), k, threshold)
    got = rows(pairs.select("source_id", "target_id", "rank", F.round("score", 5)))
    assert got == sorted(want)


@pytest.mark.parametrize("few,bands", [(16, [0.0]), (0, [0.8, 0.4, 0.0])])
def test_names_meet_by_number_in_one_pass_where_pairs_are_few(frame, rows, monkeypatch, few, bands):
    for name, value in (("_FREQUENT", 2), ("_FEW_PAIRS", few), ("_COMMON_DF", 4)):
        monkeypatch.setattr(match, name, value, raising=False)
    passes, plain = [], match._scored_pairs
    monkeypatch.setattr(match, "_scored_pairs", lambda s, t, band, limit=None: passes.append(
        (band, dict(s.dtypes)["_features"], dict(t.dtypes)["_features"])) or plain(s, t, band, limit))
    s = frame("id int, name string", *[(i, f"Pump-{i}-x") for i in range(20)], (90, "pump-3-x"))
    t = frame("id int, name string", *[(i, f"pump-valve-{i}") for i in range(20, -1, -1)])
    pairs = match_pairs(s, t, MatchModel(("name",), ("name",), "insensitive"), 2)
    own = [(i, i) for i in range(20)] + [(90, 3)]
    want = [(i, n, 1, 0.667) for i, n in own] + [(i, 1 if n == 0 else 0, 2, 0.333) for i, n in own]
    assert rows(pairs.select("source_id", "target_id", "rank", F.round("score", 3))) == sorted(want)
    assert passes == [(band, "bigint", "bigint") for band in bands]


def test_missing_fields(frame, rows):
    sources = frame("id int, a string, b string", (1, "pump", None), (2, "pump", "x"))
    targets = frame("id int, a string, b string", (7, "pump", "x"))
    model = lambda ignore: MatchModel(("a", "b"), ("a", "b"), ignore_missing=ignore)
    assert rows(match_pairs(sources, targets, model(True)), "source_id") == [(1,), (2,)]
    assert rows(match_pairs(sources, targets, model(False)), "source_id") == [(2,)]
    with pytest.raises(ValueError):
        MatchModel(("a",), ())


def test_supervised_learns_case_and_zeros(spark, rows):
    names = [f"Unit{i:02}-Area{i % 5}" for i in range(40)]
    sources = spark.createDataFrame([(i, n.upper().replace("-", "_")) for i, n in enumerate(names)], "id int, name string")
    targets = spark.createDataFrame([(i, n.replace("-", " 0")) for i, n in enumerate(names)], "id int, name string")
    truth = spark.createDataFrame([(i, i) for i in range(0, 40, 4)], "source_id int, target_id int")
    model = MatchModel(("name",), ("name",))
    fitted = fit_supervised(sources, targets, truth, model)
    got = rows(predict_supervised(fitted, sources, targets, model), "source_id", "target_id")
    assert sum(a == b for a, b in got) >= 36 and len(got) == 40


def _plain(spark, count):
    """Names of common tokens and a number each; the first is long."""
    words = [f"plant-line-{'ab'[i % 2]}-{i}" + ("-plant2-line3-a4-b5" if i == 0 else "") for i in range(count)]
    return spark.createDataFrame(list(enumerate(words)), "id int, name string")


@pytest.mark.parametrize("kind", ["insensitive", "bigram"])
def test_few_long_names_leave_common_tokens_common(spark, rows, monkeypatch, kind):
    names, model = _plain(spark, 24), MatchModel(("name",), ("name",), kind)
    want = rows(match_pairs(names, names, model, 3))
    monkeypatch.setattr(match, "_COMMON_DF", 4)
    monkeypatch.setattr(match, "_COMMON_PER_NAME", 2)
    limits, plain = [], match._common_limit
    monkeypatch.setattr(match, "_common_limit", lambda v: limits.append(plain(v)) or limits[-1])
    monkeypatch.setattr(match, "_LONG_NAMES", 1024, raising=False)
    assert rows(match_pairs(names, names, model, 3)) == want
    assert limits == [(4, True)]


def test_supervised_meets_common_tokens_by_class(spark, rows, monkeypatch):
    names, model = _plain(spark, 24), MatchModel(("name",), ("name",))
    other = names.withColumn("name", F.concat(F.upper("name"), F.lit("-x")))
    truth = names.where("id % 3 = 0").select(F.col("id").alias("source_id"), F.col("id").alias("target_id"))
    fitted = fit_supervised(other, names, truth, model)
    want = rows(predict_supervised(fitted, other, names, model, 4))
    monkeypatch.setattr(match, "_COMMON_DF", 3)

    def never(*_):
        raise AssertionError("names are paired by common tokens")

    monkeypatch.setattr(match, "_scored_pairs", never)
    assert rows(predict_supervised(fitted, other, names, model, 4)) == want


def test_annotations(frame, rows):
    docs = frame("doc_id int, text string", (1, "See pump 23-DB-9101, and 23_db_9101!"), (2, "23 DB only; 9101"), (3, None), (4, ""))
    entities = frame("id int, name string", (1, "23-DB-9101"), (2, "23 db 9101"), (3, "pump"), (4, "23-XX-77"))
    hits = detect_annotations(docs, entities, "name")
    assert rows(hits, "doc_id", "start", "stop", "text") == [(1, 9, 19, "23-DB-9101"), (1, 25, 35, "23_db_9101")]
    assert rows(annotation_entities(hits, entities, "name"), "id", "start") == [(1, 9), (1, 25), (2, 9), (2, 25)]
    partial = detect_annotations(docs, entities, "name", partial_match=True)
    assert rows(partial, "doc_id", "text", "confidence") == [
        (1, "23-DB-9101", 1.0), (1, "23_db_9101", 1.0), (2, "23 DB", pytest.approx(2 / 3))]
    single = detect_annotations(docs, entities, "name", min_tokens=1)
    assert ("pump" in [r[0] for r in rows(single, "text")]) and single.count() == 3


def test_ambiguous_partial_matches_are_left_out(frame, rows):
    docs = frame("doc_id int, text string", (1, "the 23 DB line and DB 2 line"))
    entities = frame("id int, name string", (1, "23-DB-1"), (2, "23-DB-2"))
    hits = detect_annotations(docs, entities, "name", partial_match=True)
    assert rows(hits, "text", "name_key") == [("DB 2", "23 db 2")]
