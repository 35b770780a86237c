"""A text corpus from raw documents to a training mix, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the columns
of ``docs``. Stages keep rows with null ids and do not move rows unless rows must meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.lineage import materialize
from millrace.llm import contamination, minhash, mixing, pii, toxicity
from millrace.llm.frames import table
from millrace.llm.queries import toxicity_labels

# Scores come from a fitted model and the added spans from boosted trees, which SQL cannot express.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.3 or more go."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, toxicity_labels(spark, sf_dir)))


def _packed(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` and all other columns in one, so that none of them can clash with those of an operator."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", (F.struct(*others) if others else F.lit(0)).alias("row"))


def _unpacked(packed: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` again, some of them replaced."""
    held = lambda c: F.col(c) if c in ("doc_id", "text") else F.col("row")[c]
    return packed.select(*[changed.get(c, held(c)).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8) stays, that with the smallest id.

    Texts that share an id without being alike all stay.
    """
    return _unpacked(minhash.one_per_group(_packed(docs), percent=80, by_text=True), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item, or all of a shorter one, go."""
    return contamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by the name of its kind; ``n_chars`` follows the text."""
    found = pii.find(_packed(docs), pii.fit(docs))
    texts = found.select("doc_id", pii.redacted(F.col("text"), F.col("spans")).alias("text"), "row")
    size = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return _unpacked(texts, docs, **size)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = materialize(docs, name)
    return docs
