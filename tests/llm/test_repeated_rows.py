"""Spans of rows that repeat each other."""

import pytest

from millrace.llm import debruijn


@pytest.mark.parametrize("doc_id", [1, None])
def test_spans_of_repeated_rows_are_held_once(spark, doc_id):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(doc_id, text)] * 25 + [(2, text + " end"), (3, " ".join(["x"] * 5 + text.split()[20:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _, spans = debruijn.paths_and_spans(docs, 10)
    lists = [[tuple(x) for x in r["found"]] for r in spans.collect()]
    assert len(lists) == 3 and all(len(x) == len(set(x)) for x in lists)
