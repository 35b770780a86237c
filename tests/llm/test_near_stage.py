"""The near-duplicate stage of the pipeline."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from millrace.llm.queries import QUERIES  # noqa: E402

DDL = "doc_id long, text string, lang string, source string, n_chars long"


def copies_of_one(spark):
    """Similarity to the first text: 0.82, 0.80 (152 of 190 five-word runs) and 0.78."""
    words = [f"w{i}" for i in range(175)]
    texts = [words] + [words[:-cut] + [f"n{cut}x{i}" for i in range(cut)] for cut in (17, 19, 21)]
    return spark.createDataFrame([(i, " ".join(t), "en", "a", 1) for i, t in enumerate(texts)], DDL)


def test_stage_drops_copies_from_similarity_80(spark):
    kept = corpus_pipeline.drop_near_duplicates(spark, copies_of_one(spark).where("doc_id != 1"), "").collect()
    assert sorted(r["doc_id"] for r in kept) == [0, 3]
    pair = corpus_pipeline.drop_near_duplicates(spark, copies_of_one(spark).where("doc_id < 2"), "").collect()
    assert [r["doc_id"] for r in pair] == [0]


def test_op10_links_from_similarity_85(spark, tmp_path):
    copies_of_one(spark).write.parquet(str(tmp_path / "documents.parquet"))
    assert all(r["kept"] for r in QUERIES["op10_minhash_near_dedup"](spark, str(tmp_path)).collect())


def test_texts_that_only_share_an_id_stay(spark):
    text = lambda k: " ".join(f"{k}{i}" for i in range(40))
    rows = [(1, text("a")), (5, text("a")), (5, text("b")), (5, text("c")), (5, text("c")), (6, text("c")), (7, ""), (7, None),
            (None, text("a")), (9, "one\u00a0two"), (9, "\t \n")]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], DDL)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    want = [(1, text("a")), (5, text("b")), (5, text("c")), (7, ""), (7, None), (None, text("a")), (9, "one\u00a0two"), (9, "\t \n")]
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=key) == sorted(want, key=key)
