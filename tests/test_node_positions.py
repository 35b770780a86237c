"""Positions in the node listing."""

from pyspark.sql import functions as F

from workload import load_all
from workload.registry import QUERIES


def test_positions_without_one_task_for_all_nodes(spark):
    load_all()
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        out = QUERIES["node_list_positions"](spark, "/root/testdata/sf0.01").withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset(key)
    assert sorted(r["position"] for r in out) == list(range(1, len(out) + 1))
    assert len({r["task"] for r in out}) > 1
