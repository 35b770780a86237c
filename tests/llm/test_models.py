"""Learned operators, sampling, search and archives."""

import hashlib
import io
import random
import re
import struct
import zipfile
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import archives, forest, language, mixing, pii, toxicity


# -- toxicity --------------------------------------------------------------------------------------

def all_maximal(scores):
    """Maximal segments by their recursive definition: the best one, then those left and right of it."""
    best, span = 0.0, None
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            if sum(scores[a:b]) > best + 1e-12:
                best, span = sum(scores[a:b]), (a, b)
    if span is None:
        return []
    a, b = span
    return all_maximal(scores[:a]) + [(a, b)] + [(x + b, y + b) for x, y in all_maximal(scores[b:])]


@pytest.mark.parametrize("seed", range(20))
def test_maximal_segments(seed):
    rng = random.Random(seed)
    scores = [rng.choice([-3.3, -1.1, -0.7, 0.9, 2.3, 1.7]) + rng.random() / 100 for _ in range(25)]
    assert [(a, b) for a, b, _ in toxicity.maximal_segments(np.array(scores))] == all_maximal(scores)


@pytest.fixture(scope="module")
def toxic(spark):
    rng = random.Random(3)
    words = [f"word{i}" for i in range(300)]
    rows, labels = [(900, None, "x"), (901, "", "x"), (None, "word1 word2", "x"), (902, "word1 " * 5000, "x")], [(900, 0), (None, 1), (901, None)]
    for i in range(800):
        text = [rng.choice(words) for _ in range(rng.randint(20, 80))]
        bad = i % 5 == 0
        if bad:
            at = rng.randrange(len(text))
            text[at:at] = [rng.choice(["vile", "nasty", "grim"]) + rng.choice(["", "er", "est"]) for _ in range(3)]
        rows.append((i, " ".join(text), "x"))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, label int")


def test_toxicity(toxic):
    docs, labels = toxic
    model = toxicity.fit(docs, labels.where("doc_id % 4 != 2"))
    rows = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(800) if i % 4 == 2]
    right = sum((rows[i]["score"] >= 0.3) == (i % 5 == 0) for i in held)
    assert right >= 0.97 * len(held)
    assert rows[900]["score"] == rows[901]["score"] < 0.3 and rows[902]["score"] < 0.3 and None in rows
    found = rows[10]["passages"]
    words = docs.where("doc_id = 10").first()["text"].split()
    assert any(re.match("vile|nasty|grim", w) for p in found for w in words[p["start"]:p["stop"]])
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in rows.items() if r["score"] < 0.3}


def test_toxicity_without_rows_or_labels(spark, toxic):
    docs, labels = toxic
    none = toxicity.fit(docs, labels.limit(0))
    assert toxicity.score(docs.limit(3), none).first()["score"] == pytest.approx(0.5)
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels)).count() == 0


# -- language --------------------------------------------------------------------------------------

def test_language(spark):
    rng = random.Random(4)
    syllables = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ung", "ei", "pf"], "cc": ["é", "eau", "oi", "ç"]}
    rows = []
    for i in range(240):
        lang = "abc"[i % 3] * 2
        text = " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(10, 90)))
        rows.append((i, text, lang, "x"))
    rows += [(500, None, "aa", "x"), (501, "", None, "x"), (502, "12 34 !!", "bb", "x"), (None, "kalomi tumi " * 3000, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    model = language.fit(docs.where("doc_id % 5 != 0"))
    got = {r["doc_id"]: r for r in language.predict(docs, model).collect()}
    held = [i for i in range(0, 240, 5)]
    assert sum(got[i]["lang_pred"] == "abc"[i % 3] * 2 for i in held) >= 0.95 * len(held)
    assert [got[i]["lang_pred"] for i in (500, 501, 502)] == ["und"] * 3 and got[None]["lang_pred"] == "aa"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    again = language.fit(docs.where("doc_id % 5 != 0").repartition(7))
    assert np.array_equal(model.first, again.first)
    empty = docs.limit(0)
    assert language.predict(empty, language.fit(empty)).count() == 0
    assert language.predict(docs.where("doc_id = 1"), language.fit(empty)).first()["lang_pred"] == "und"


def test_folded_tables_equal_the_network():
    rng = np.random.default_rng(0)
    windows = rng.integers(0, 256, (40, language.WINDOW)).astype(np.uint8)
    model = language.train(windows, np.arange(40) % 2, ["a", "b"])
    p = model.probabilities(windows)
    assert p.shape == (40, 2) and np.allclose(p.sum(axis=1), 1)


def test_fold_equals_plain_convolutions():
    rng = np.random.default_rng(1)
    p = {"embed": rng.normal(size=(256, language.EMBEDDING)), "bias": rng.normal(size=3 * language.FILTERS),
         "dense": rng.normal(size=(3 * language.FILTERS, 3)), "out": rng.normal(size=3)}
    for w in language.WIDTHS:
        p[f"f{w}"] = rng.normal(size=(w * language.EMBEDDING, language.FILTERS))
    windows = rng.integers(0, 256, (5, 40)).astype(np.uint8)
    got = language.fold(p, ["a", "b", "c"]).probabilities(windows)
    for at, window in enumerate(windows):
        cells = p["embed"][np.append(window, [0, 0, 0])]
        pooled = np.concatenate([
            np.max([cells[i: i + w].ravel() @ p[f"f{w}"] for i in range(len(window))], axis=0) for w in language.WIDTHS])
        e = np.exp(np.maximum(pooled + p["bias"], 0) @ p["dense"] + p["out"])
        assert np.allclose(got[at], e / e.sum(), atol=1e-4)


def test_language_sample_of_null_and_repeated_ids(spark):
    rows = [(None, f"wir gehen heute nach haus {i}", "de") for i in range(300)] + [(7, f"the road is long today {i}", "en") for i in range(300)]
    docs = spark.createDataFrame(rows + rows[:1] * 200, "doc_id long, text string, lang string")
    seen = []
    train = language.train
    language.train = lambda windows, labels, languages: seen.append(np.bincount(labels).tolist()) or train(windows, labels, languages)
    try:
        language.fit(docs, per_language=50)
    finally:
        language.train = train
    de, en = seen[0]
    assert 10 <= de <= 60 and 25 <= en <= 90  # one window a text; neither all nor none


def test_toxicity_of_texts_with_both_labels(spark):
    docs = spark.createDataFrame([(i, f"quiet text number {i % 40}" if i < 80 else f"vile hateful words {i}", "x") for i in range(160)], "doc_id long, text string, s string")
    labels = spark.createDataFrame([(i, int(i < 40 or i >= 80)) for i in range(160)], "doc_id long, label int")
    one, two = (toxicity.fit(d, labels) for d in (docs.repartition(3), docs.orderBy(F.desc("doc_id")).coalesce(1)))
    assert all(np.array_equal(a, b) for a, b in zip(vars(one).values(), vars(two).values()))


# -- personal data ---------------------------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes_luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_of(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m.group().split(".")),
                    "card": lambda: 13 <= len(digits) <= 19 and passes_luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()
            if good:
                out.append((pii.KINDS.index(kind), m.start(), m.end()))
    return out


def random_text(rng):
    bits = ["a.b@c.de", "a@b.c@d.e", "x@y", "@", ".", "-", " ", "  ", "é", "世", "+1 (555) 123-4567", "+", "1.2.3.4", "1.2.3.4.5", "300.1.1.1",
            "001.02.3.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "5500000000000004", "12", "7", "--", "_", "a", "(", ")", "%", "\n", "0" * 14, "9" * 25]
    return "".join(rng.choice(bits) for _ in range(rng.randint(0, 30)))


def test_base_spans(spark):
    rng = random.Random(9)
    texts = [random_text(rng) for _ in range(600)] + ["", "a" * 60_000, "1" * 60_000, "1 " * 30_000, "+1" + " " * 20_000, "a." * 20_000 + "@b", "1.2.3.4 " * 3000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {r["i"]: [tuple(s) for s in r["b"]] for r in df.select("i", pii.base_spans(F.col("text")).alias("b")).collect()}
    assert [i for i, t in enumerate(texts) if got[i] != base_of(t)] == []


def test_added_spans_and_redaction(spark):
    rng = random.Random(1)

    def card(separator, good=True):
        d = "".join(rng.choice("123456789") for _ in range(15))
        d += next(c for c in "0123456789" if passes_luhn(d + c) == good)
        return separator.join(d[i:i + 4] for i in range(0, 16, 4))

    rows = [(i, f"pay with card {card('')} or {card('', False)} at noon, dear friend", "x", "x") for i in range(400)]
    rows += [(1000, "pay with card " + card(".") + " at noon", "x", "x"), (1001, None, "x", "x"), (1002, "", "x", "x"), (None, "mail a@b.cd now", "x", "x"),
             (1003, "see é a@b.cd and +1 555 123 4567", "x", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, value string")
    model = pii.fit(docs)
    found = pii.find(docs, model)
    assert found.columns == ["doc_id", "text", "spans", "value", "base_spans"] or set(found.columns) == {*docs.columns, "base_spans"}
    got = {r["doc_id"]: r for r in found.withColumn("clean", pii.redacted(F.col("text"), F.col("spans"))).collect()}
    assert all(set(map(tuple, r["base_spans"])) <= set(map(tuple, r["spans"])) for r in got.values())
    assert [tuple(s) for s in got[1000]["spans"]] == [(2, 14, 33)] and not got[1000]["base_spans"]  # dots are no base separator
    assert all(len(got[i]["spans"]) == 1 for i in range(400))
    assert got[1003]["clean"] == "see é <EMAIL> and <PHONE>" and got[None]["clean"] == "mail <EMAIL> now"
    assert got[1001]["clean"] is None and got[1002]["clean"] == ""
    assert pii.find(docs.limit(0), pii.fit(docs.limit(0))).count() == 0


# -- mixing ----------------------------------------------------------------------------------------

def water_level(sizes, weights, share, most):
    """Targets by repeated sharing of what does not fit."""
    full, rest = {}, dict(sizes)
    total = share * sum(sizes.values())
    while rest:
        left = (total - sum(full.values())) / sum(weights[s] for s in rest)
        over = {s: most * n for s, n in rest.items() if left * weights[s] > most * n}
        if not over:
            return full | {s: left * weights[s] for s in rest}
        full |= over
        rest = {s: n for s, n in rest.items() if s not in over}
    return full


def test_mixing(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice(["a", "b", "C", "é", None, "b"]) if i % 3 else "hot", "w " * rng.randint(0, 60), "x") for i in range(3000)]
    rows += [(None, "a", "one two", "x"), (5, "b", None, "x"), (5, "b", "again and again", "x"), (7, "empty", "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, size string")
    first, second = (mixing.mix(d).collect() for d in (docs, docs.repartition(9)))
    key = lambda r: (str(r["source"]), str(r["doc_id"]), r["size"], r["taken"])
    assert sorted(map(key, first)) == sorted(map(key, second)) and len(first) == len(rows)
    sizes = Counter()
    for _, s, t, _ in rows:
        sizes[s] += len((t or "").split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    want = water_level(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 1.5, 2.0)
    taken = Counter()
    for r in first:
        assert r["taken"] <= 2 * r["size"] and r["target"] == pytest.approx(want[r["source"]])
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 60 for s in sizes)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_weights_change_the_odds(spark):
    docs = spark.createDataFrame([(i, "s", "a b c d", 20.0 if i % 2 else 1.0) for i in range(2000)], "doc_id long, source string, text string, w double")
    got = mixing.mix(docs, share=0.5, weight="w").groupBy(F.col("doc_id") % 2).agg(F.sum("copies").alias("n")).collect()
    share = {r[0]: r["n"] for r in got}
    assert share[1] > 3 * share[0] and sum(share.values()) == 1000


# -- nearest neighbours ----------------------------------------------------------------------------

def test_forest_recall_and_exact_scores(spark):
    rng = np.random.default_rng(2)
    data = rng.normal(size=(1500, 16)).astype(np.float32)
    rows = [(i, [float(x) for x in v], "x") for i, v in enumerate(data)]
    rows += [(2000, None, "x"), (2001, [0.0] * 16, "x"), (2002, [float("nan")] + [1.0] * 15, "x"), (2003, [None] + [1.0] * 15, "x"), (None, rows[0][1], "x"),
             (2004, [1.0, 2.0], "x"), (2005, [], "x"), (3000, rows[3][1], "x"), (3001, rows[3][1], "x"), (0, rows[0][1], "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string").repartition(3)
    got = forest.nearest(table, table.where("vec_id % 100 = 0")).collect()
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    usable = [(i, np.array(v, np.float64)) for i, v, _ in rows if i is not None and v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)]
    hit = 0
    queries = {i: v for i, v in usable if i % 100 == 0}
    assert set(by) == set(queries)
    for q, v in queries.items():
        exact = sorted((float(np.sqrt(((w - v) ** 2).sum())), i) for i, w in usable if i != q)
        near = dict((i, s) for s, i in exact)
        assert [r for r, _, _ in sorted(by[q])] == list(range(1, 11))
        assert all(s == pytest.approx(near[i], abs=1e-12) for _, i, s in by[q])
        assert [(s, i) for _, i, s in sorted(by[q])] == sorted((s, i) for _, i, s in by[q])
        hit += len({i for _, i, _ in by[q]} & {i for _, i in exact[:10]})
    assert hit >= 0.9 * 10 * len(queries)
    assert forest.nearest(table.limit(0), table.limit(0)).count() == 0
    few = table.where("vec_id in (1, 2, 100)")
    assert forest.nearest(few, few.where("vec_id = 100")).count() == 2


def test_forest_compares_few_vectors(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(6000, 24))
    data[4000:] = data[17]  # a third of the rows hold one vector; distinct ones must not lose their place to it
    names = np.arange(len(data))
    asked = names[:2000:100]
    share, hit = [], 0
    for query, found, score, compared in forest.search(forest.planes(data), names, data, asked, data[asked], 10):
        exact = np.sqrt(((data - data[query]) ** 2).sum(axis=1))
        assert np.array_equal(score, exact[found]) and query not in found
        others = names[names != query]
        best = np.sort(exact[others])[:10]
        hit += (score <= best[-1]).sum()
        share.append(compared / 4000)
    assert hit >= 0.9 * 10 * len(asked)
    assert max(share) < 0.1


def test_forest_copies_of_a_query(spark):
    data = np.ones((50, 3))
    data[:25] = np.arange(75).reshape(25, 3) + 5.0
    (_, found, score, _), = forest.search(forest.planes(data), np.arange(50), data, np.array([30]), data[[30]], 10)
    assert found.tolist() == [25, 26, 27, 28, 29, 31, 32, 33, 34, 35] and (score == 0).all()
    names = np.where(np.arange(50) < 45, 7, np.arange(50))  # more rows of the query's own id than neighbours asked for
    (_, found, _, _), = forest.search(forest.planes(data), names, data, np.array([7]), data[[30]], 3)
    assert found.tolist() == [45, 46, 47]


# -- archives --------------------------------------------------------------------------------------

def test_archives_round_trip(spark, monkeypatch):
    long, short = "<p>é</p>" * 200, "tiny"
    rows = [(1, "http://a", long, "x"), (2, "http://b", long, "x"), (9, "http://c\r\nX: y", long, "x"), (3, None, short, "x"), (4, "u", short, "x"), (5, "u", None, "x"),
            (6, "u", "", "x"), (None, "u", long, "x"), (None, "u", "z" * 2000, "x"), (9, "again", long, "x"), (7, "u", "q\r\n\r\n" * 400, "x")]
    rows += [(100 + i, f"http://p/{i}", f"page {i} " * 50, "x") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string")
    monkeypatch.setattr(archives, "ARCHIVE_BYTES", 4000)
    monkeypatch.setattr(archives, "READ_BYTES", 700)
    manifest = archives.write_archives(pages)
    assert manifest.agg(F.sum("records")).first()[0] == len(rows)
    got = archives.read_archives(manifest).collect()

    def want(page_id, html):
        body = (html or "").encode()
        same = [i for i, _, h, _ in rows if i is not None and (h or "").encode() == body]
        top = max(same) if same and len(body) >= 1000 else None
        revisit = top is not None and page_id != top
        return (page_id, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", top if revisit else None, None if revisit else body)

    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], None if r["payload"] is None else bytes(r["payload"]))
                   for r in got) == Counter(want(i, h) for i, _, h, _ in rows)
    assert archives.read_archives(archives.write_archives(pages.limit(0))).count() == 0


def test_members_of_foreign_and_zip64_files():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        with z.open("a.bin", "w", force_zip64=True) as f:
            f.write(b"A" * 100)
        z.writestr("é/b.txt", b"hello")
        z.writestr("packed", b"x" * 500, zipfile.ZIP_DEFLATED)
        z.comment = b"a comment with PK\x05\x06 inside"
    data = out.getvalue()
    read = lambda at, n: data[at: at + n]
    found = archives.members(read, len(data))
    at = archives.body_offset(read, found["é/b.txt"])
    assert data[at: at + found["é/b.txt"].size] == b"hello" and found["a.bin"].size == 100
    with pytest.raises(ValueError):
        archives.body_offset(read, found["packed"])

    # The same member behind 64 bit fields: sizes and offsets of the 32 bit ones are all ones.
    body, name = b"payload", b"big"
    local = struct.pack("<4sHHHHHIIIHH", b"PK\x03\x04", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 20) + name + struct.pack("<HHQQ", 1, 16, len(body), len(body))
    extra = struct.pack("<HHQQQ", 1, 24, len(body), len(body), 0)
    central = struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    start = len(local) + len(body)
    end64 = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(central), start)
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, start + len(central), 1)
    end = struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    big = local + body + central + end64 + locator + end
    read = lambda at, n: big[at: at + n]
    member = archives.members(read, len(big))["big"]
    at = archives.body_offset(read, member)
    assert big[at: at + member.size] == body


def test_broken_payload_is_an_error():
    raw = archives.gzip.compress(archives.record_bytes(1, "u", b"abc", hashlib.sha1(b"abd").hexdigest(), None))
    with pytest.raises(ValueError):
        archives.parse_record(raw)


def test_pii_learns_from_every_document(spark, monkeypatch):
    counted, plain = [], pii.boost
    monkeypatch.setattr(pii, "boost", lambda x, y, n, held: counted.append(n.sum()) or plain(x, y, n, held))
    pii.fit(spark.range(21_000).select(F.col("id").alias("doc_id"), F.lit("from 10.0.0.1").alias("text")))
    assert counted == [21_000]
