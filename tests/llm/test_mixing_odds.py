"""Inclusion probabilities of the mix, and archives read by many tasks."""

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import archives, mixing


def test_inclusion_follows_the_weights(spark):
    """Over many draws a document is taken about as often as its probability says; certain ones always."""
    sizes = [1, 4, 9, 16, 25, 100] * 60
    docs = spark.range(20).crossJoin(spark.createDataFrame([(i, "a " * n) for i, n in enumerate(sizes)], "k long, text string")).select(
        (F.col("id") * 1000 + F.col("k")).alias("doc_id"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("source"), "text")
    got = mixing.mix(docs, weights=(1.0,), share=0.3).groupBy("size").agg(F.avg("copies").alias("p")).collect()
    part = {r["size"]: r["p"] for r in got}
    g = np.floor(np.sqrt(sizes))
    p = {n: 0.3 * np.floor(np.sqrt(n)) * sum(sizes) / (np.array(sizes) @ g) for n in set(sizes)}
    assert all(abs(part[n] - p[n]) < 0.03 for n in p)
    # One long document is certain.
    one = spark.createDataFrame([(i, "s", "w " * (4000 if i == 7 else 2)) for i in range(1000)], "doc_id long, source string, text string")
    taken = {r["doc_id"]: r["copies"] for r in mixing.mix(one, share=0.7).collect()}
    assert taken[7] == 1


def test_rows_without_an_id_do_not_draw_alike(spark):
    docs = spark.createDataFrame([(None, "s", f"text {i} of many words") for i in range(400)], "doc_id long, source string, text string")
    copies = [r["copies"] for r in mixing.mix(docs, share=0.5).collect()]
    assert sum(copies) == 200


def test_archives_are_read_by_many_tasks(spark, monkeypatch):
    pages = spark.createDataFrame([(i, f"u{i}", f"<p>{i}</p>" * 200) for i in range(300)], "page_id long, url string, html string").repartition(6)
    manifest = archives.write_archives(pages)
    number = manifest.select("archive").distinct().count()
    assert number > 1
    odd = manifest.unionByName(manifest).unionByName(manifest.limit(1).withColumn("archive", F.lit(None).cast("string")))
    read = archives.read_archives(odd, payloads=False)
    assert read.count() == 300
    assert read.groupBy(F.spark_partition_id()).count().count() == number
