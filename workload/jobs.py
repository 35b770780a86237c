"""Runs, jobs and metrics."""

from pyspark.sql import functions as F

from millrace.operators.runs import latest_metrics, run_gaps, with_job_details, with_latest_status
from millrace.plans.filters import compile_filter
from workload.mapping import RUNS, runs, table
from workload.registry import query


@query("run_latest_status", f"""WITH {RUNS}, last AS (
  SELECT external_id, max(created_time) FILTER (status = 'success') AS last_success,
         max(created_time) FILTER (status = 'failure') AS last_failure, max(created_time) FILTER (status = 'seen') AS last_seen,
         arg_max(message, created_time) FILTER (message IS NOT NULL) AS last_message FROM runs GROUP BY 1)
SELECT CAST(c.c_custkey AS VARCHAR) AS external_id, last_success, last_failure, last_seen, last_message
FROM customer c LEFT JOIN last l ON l.external_id = CAST(c.c_custkey AS VARCHAR)""")
def run_latest_status(spark, sf):
    feeds = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("external_id"))
    return with_latest_status(feeds, runs(spark, sf))


@query("run_gaps", f"""WITH {RUNS}, beats AS (SELECT DISTINCT external_id, created_time FROM runs WHERE status = 'seen'),
near AS (SELECT external_id, created_time, lag(created_time) OVER (PARTITION BY external_id ORDER BY created_time) AS before FROM beats)
SELECT external_id, before AS gap_start, created_time AS gap_end, created_time - before AS gap_ms FROM near
WHERE created_time - before > 3600000""")
def gaps(spark, sf):
    return run_gaps(runs(spark, sf), 3_600_000)


@query("run_filter", f"""WITH {RUNS}
SELECT external_id, created_time, status, message FROM runs
WHERE status IN ('failure', 'success') AND contains(message, 'run 1') AND created_time >= 1704500000000 AND created_time <= 1706000000000""")
def run_filter(spark, sf):
    spec = {"statuses": ["failure", "success"], "message": {"substring": "run 1"},
            "createdTime": {"min": 1_704_500_000_000, "max": 1_706_000_000_000}}
    return runs(spark, sf).where(compile_filter(spec))


@query("log_severity", "SELECT p_partkey AS id FROM part WHERE p_size % 10 >= 5")
def log_severity(spark, sf):
    logs = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), (F.col("p_size") % 10).alias("severity"))
    return logs.where(compile_filter({"severity": 5})).select("id")


def _jobs(spark, sf):
    """Orders as jobs of a transformation per customer; open orders still run."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("job_id"), F.col("o_custkey").alias("transformation_id"),
        F.when(F.col("o_orderstatus") == "O", "Running").when(F.col("o_orderstatus") == "F", "Completed").otherwise("Failed").alias("status"),
        (F.unix_millis(F.col("o_orderdate").cast("timestamp")) * 1000 + F.col("o_orderkey") % 1000).alias("created_time"))


@query("job_details", """
WITH j AS (SELECT o_orderkey AS job_id, o_custkey AS t, CASE o_orderstatus WHEN 'O' THEN 'Running' WHEN 'F' THEN 'Completed' ELSE 'Failed' END AS status,
                  epoch_ms(o_orderdate) * 1000 + o_orderkey % 1000 AS created FROM orders)
SELECT c_custkey AS id, arg_max(job_id, created) FILTER (status = 'Running') AS running_job_id,
       arg_max(job_id, created) FILTER (status <> 'Running') AS last_job_id,
       arg_max(status, created) FILTER (status <> 'Running') AS last_job_status
FROM customer LEFT JOIN j ON t = c_custkey GROUP BY 1""")
def job_details(spark, sf):
    return with_job_details(table(spark, sf, "customer").select(F.col("c_custkey").alias("id")), _jobs(spark, sf))


@query("job_metrics", """
SELECT user_id AS job_id, event_type AS name, max(epoch_us(ts)) AS "timestamp", arg_max(event_id, epoch_us(ts)) AS "count"
FROM events GROUP BY ALL""")
def job_metrics(spark, sf):
    metrics = table(spark, sf, "events").select(
        F.col("user_id").alias("job_id"), F.col("event_type").alias("name"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("timestamp"), F.col("event_id").alias("count"))
    return latest_metrics(metrics)
