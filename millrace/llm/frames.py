"""Small Spark helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from millrace.lineage import materialize
from millrace.session import prepare

# Rows per Arrow batch: batches stay small where texts are long.
BATCH_ROWS = 1000


def session_of(df: DataFrame) -> SparkSession:
    """The session of ``df`` with the settings that the operators rely on."""
    spark = prepare(df.sparkSession)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges (a long, b long)``: ``(node, component)`` with the smallest node.

    Alternates the large-star and small-star steps until nothing changes; every round is a join
    and an aggregate on the edges and is written to the shared folder. Hot nodes are a skewed
    join key, which adaptive execution splits. Nodes without an edge do not occur.
    """
    current = materialize(
        edges.where("a is not null and b is not null and a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Written first: a join of two plain scans can split a hot node over many tasks.
        least = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        linked = (large.join(small, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                  .union(small.select("a", F.col("m").alias("b"))).where("a != b").distinct())
        seen = Observation()
        current = materialize(linked.observe(
            seen, F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("state")), "edges")
        state = (seen.get["n"], seen.get["state"])
        if state == before or state[0] == 0:
            break
        before = state
    star = current.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    return star.union(star.select(F.col("component").alias("node"), "component").distinct())
