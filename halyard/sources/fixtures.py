"""Operator inputs derived from the supplied tables (see FIXTURES.md).

Each builder is a plain DataFrame expression over the base tables, so the
work grows with the data and every filter / projection reaches the parquet
scan.  ``FIXTURE_SQL`` holds the same derivations as SQL text; the oracle
queries put them in front of their SELECT as CTEs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from halyard.sources.tables import read_table


def _case(col: Column, pairs, default) -> Column:
    expr = None
    for key, val in pairs:
        expr = (F.when(col == key, val) if expr is None else expr.when(col == key, val))
    return expr.otherwise(default)


def customer_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    k = F.col("c_custkey")
    nk5 = F.col("c_nationkey") % 5
    base = c.select(
        k.alias("customer_id"),
        (18 + (k * 7) % 85).cast("int").alias("age"),
        F.when(k % 2 == 0, "Female").otherwise("Male").alias("gender"),
        ((k * 13) % 72).cast("int").alias("tenure_months"),
        F.when(k % 10 < 5, "Month-to-month").when(k % 10 < 8, "One year").otherwise("Two year").alias("contract_type"),
        _case(k % 4, [(0, "Electronic check"), (1, "Mailed check"), (2, "Bank transfer")], "Credit card").alias("payment_method"),
        F.when(nk5 < 2, "DSL").when(nk5 < 4, "Fiber optic").otherwise("No").alias("internet_service"),
        (F.when(nk5 < 2, 50).when(nk5 < 4, 80).otherwise(20) + F.col("c_acctbal") / 1000).alias("monthly_charges"),
    )
    weight = (_case(F.col("contract_type"), [("Month-to-month", 30), ("One year", 10)], 5)
              + F.when(F.col("tenure_months") < 12, 10).otherwise(0)
              + F.when(F.col("monthly_charges") > 80, 10).otherwise(0))
    return base.select(
        "customer_id", "age", "gender", "tenure_months", "contract_type", "payment_method", "internet_service",
        "monthly_charges",
        (F.col("monthly_charges") * F.col("tenure_months")).alias("total_charges"),
        F.when((F.col("customer_id") * 31) % 100 < weight, 1).otherwise(0).cast("int").alias("churn"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.where(F.col("o_custkey") % 10 < 7).select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("transaction_date"),
        F.col("o_totalprice").alias("amount"),
        _case(F.col("o_orderstatus"), [("F", "Payment"), ("O", "Refund")], "Adjustment").alias("transaction_type"),
    )


def support_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return e.where(F.col("event_type") == "error").select(
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("ticket_date"),
        F.when(eid % 10 < 5, "Technical").when(eid % 10 < 8, "Billing").otherwise("Service").alias("issue_type"),
        F.col("value").alias("resolution_time_hours"),
    )


def product_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").where(F.col("o_custkey") % 10 < 6)
    g = o.groupBy("o_custkey").agg(
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("_cents"),
        F.count(F.lit(1)).alias("_n"),
        F.min("o_orderkey").alias("_first"),
    )
    return g.select(
        F.col("o_custkey").alias("customer_id"),
        (F.col("_cents") / (F.col("_n") * 100000).cast("double")).alias("avg_monthly_usage_gb"),
        _case(F.col("_first") % 4, [(0, "Morning"), (1, "Afternoon"), (2, "Evening")], "Night").alias("peak_usage_hours"),
        (F.col("_n") % 5).cast("int").alias("streaming_services_used"),
    )


def workload_hourly(spark: SparkSession, sf_dir: str, series_col: bool = False) -> DataFrame:
    """Hourly telemetry rows; ``series_col`` adds ``series_id`` (user_id % 4)."""
    e = read_table(spark, sf_dir, "events")
    keys = [F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("timestamp_h")]
    if series_col:
        keys.append((F.col("user_id") % 4).alias("series_id"))
    g = e.groupBy(*keys).agg(
        F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("_cents"),
        F.count(F.lit(1)).alias("_n"),
        F.max("value").alias("_vmax"),
        F.sum(F.when(F.col("event_type") == "click", 1).otherwise(0)).alias("_clicks"),
        F.countDistinct("user_id").alias("_users"),
    )
    cols = ([F.col("series_id")] if series_col else []) + [
        F.col("timestamp_h"),
        F.least(F.col("_cents") / (F.col("_n") * 10000).cast("double"), F.lit(1.0)).alias("cpu_usage"),
        F.least(F.col("_vmax") / 400, F.lit(1.0)).alias("memory_usage"),
        (F.col("_clicks") / F.col("_n").cast("double")).alias("gpu_usage"),
        F.col("_n").cast("bigint").alias("job_queue_length"),
        F.col("_users").cast("bigint").alias("active_jobs"),
        F.lit(100).alias("cluster_size"),
    ]
    return g.select(*cols)


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return e.select(
        F.concat(F.lit("job-"), eid.cast("string")).alias("job_id"),
        eid.alias("job_ordinal"),
        (F.col("user_id") % 10).alias("request_id"),
        F.col("user_id"),
        (1 + eid % 10).cast("int").alias("priority"),
        (10 + (eid * 17) % 600).cast("int").alias("estimated_runtime_minutes"),
        (1 + (eid * 7) % 16).cast("int").alias("cpu_cores_required"),
        (2 * (1 + (eid * 11) % 32)).cast("double").alias("memory_gb_required"),
        F.when(eid % 5 == 0, 1 + eid % 4).otherwise(0).cast("int").alias("gpu_count_required"),
        (50 * (1 + (eid * 7) % 16)).cast("double").alias("power_watts_estimated"),
        (1 + eid % 10).cast("double").alias("network_bandwidth_gbps"),
        _case(F.col("event_type"), [("click", "gpu"), ("view", "memory"), ("error", "network")], "compute").alias("job_type"),
        F.col("ts").alias("submission_time"),
    )


def job_dependencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events").select("event_id")
    eid = F.col("event_id")
    return e.where((eid > 0) & ((eid % 4 == 0) | (eid % 97 == 0))).select(
        F.concat(F.lit("job-"), eid.cast("string")).alias("job_id"),
        F.when(eid % 97 == 0, F.concat(F.lit("missing-"), eid.cast("string")))
        .otherwise(F.concat(F.lit("job-"), (eid - 1).cast("string"))).alias("dependency_id"),
    )


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey")
    k = F.col("s_suppkey")
    return s.select(
        F.concat(F.lit("node-"), k.cast("string")).alias("node_id"),
        k.alias("node_ordinal"),
        (k % 10).alias("request_id"),
        (64 + 16 * (k % 5)).cast("int").alias("total_cpu_cores"),
        (48 + 16 * (k % 5)).cast("int").alias("available_cpu_cores"),
        (256 + 64 * (k % 4)).cast("double").alias("total_memory_gb"),
        (192 + 64 * (k % 4)).cast("double").alias("available_memory_gb"),
        (k % 9).cast("int").alias("total_gpu_count"),
        (k % 9).cast("int").alias("available_gpu_count"),
        (4000 + 500 * (k % 3)).cast("double").alias("available_power_watts"),
        (40 + 10 * (k % 4)).cast("double").alias("available_network_bandwidth_gbps"),
        ((50 + k % 50) / F.lit(100).cast("double")).alias("node_efficiency_score"),
        (k % 13 != 0).alias("is_available"),
    )


def user_quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events").select("user_id").where(F.col("user_id") % 2 == 0)
    u = F.col("user_id")
    return e.select(
        u,
        (1 + u % 3).cast("int").alias("user_priority"),
        (40 + u % 40).cast("int").alias("max_cpu_cores"),
        F.lit(400).cast("double").alias("max_memory_gb"),
        (5 + u % 5).cast("int").alias("max_concurrent_jobs"),
    ).distinct()


def gateway_requests(spark: SparkSession, sf_dir: str, src: DataFrame | None = None) -> DataFrame:
    """``src`` may be a streaming events DataFrame (the projection is stream-safe)."""
    e = src if src is not None else read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return e.select(
        eid.alias("request_id"), F.col("ts"), F.col("user_id").alias("client_id"),
        _case(F.col("event_type"), [("view", "/api/v1/predict"), ("click", "/api/v1/optimize"),
                                    ("purchase", "/api/v1/schedule"),
                                    ("signup", "/api/v1/workflow/full-optimization")],
              "/api/v1/workflow/prediction-and-schedule").alias("path"),
        F.when(eid % 3 == 0, "GET").otherwise("POST").alias("method"),
        F.when(eid % 20 == 0, 503).when(eid % 20 == 1, 429).otherwise(200).cast("int").alias("status"),
        (F.col("value") / 50).alias("latency_seconds"),
    )


def health_checks(spark: SparkSession, sf_dir: str, src: DataFrame | None = None) -> DataFrame:
    e = src if src is not None else read_table(spark, sf_dir, "events")
    return e.select(
        _case(F.col("event_id") % 3, [(0, "workload-predictor"), (1, "resource-optimizer")],
              "scheduler-optimizer").alias("service"),
        F.when(F.col("value") > 100, "unhealthy").otherwise("healthy").alias("status"),
        F.col("ts"),
        F.floor(F.col("value")).cast("bigint").alias("latency_ms"),
    )


def churn_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    return c.select(
        k.alias("customer_id"),
        (((k * 37) % 101).cast("double") / 100).alias("churn_probability"),
        F.when((k * 37) % 101 + (k * 53) % 60 > 80, 1).otherwise(0).cast("int").alias("churn"),
    )


BUILDERS = {
    "customer_demographics": customer_demographics,
    "transactions": transactions,
    "support_tickets": support_tickets,
    "product_usage": product_usage,
    "workload_hourly": workload_hourly,
    "jobs": jobs,
    "job_dependencies": job_dependencies,
    "nodes": nodes,
    "user_quotas": user_quotas,
    "gateway_requests": gateway_requests,
    "health_checks": health_checks,
    "churn_scores": churn_scores,
}


# The same derivations as SQL text (FIXTURES.md); used by the DuckDB oracle.
FIXTURE_SQL = {
    "customer_demographics": """
SELECT c.customer_id, c.age, c.gender, c.tenure_months, c.contract_type, c.payment_method, c.internet_service,
       c.monthly_charges, c.monthly_charges * c.tenure_months AS total_charges,
       CAST(CASE WHEN (c.customer_id * 31) % 100 <
            CASE c.contract_type WHEN 'Month-to-month' THEN 30 WHEN 'One year' THEN 10 ELSE 5 END
            + CASE WHEN c.tenure_months < 12 THEN 10 ELSE 0 END
            + CASE WHEN c.monthly_charges > 80 THEN 10 ELSE 0 END THEN 1 ELSE 0 END AS INT) AS churn
FROM (SELECT c_custkey AS customer_id,
             CAST(18 + (c_custkey * 7) % 85 AS INT) AS age,
             CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
             CAST((c_custkey * 13) % 72 AS INT) AS tenure_months,
             CASE WHEN c_custkey % 10 < 5 THEN 'Month-to-month' WHEN c_custkey % 10 < 8 THEN 'One year' ELSE 'Two year' END AS contract_type,
             CASE c_custkey % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check' WHEN 2 THEN 'Bank transfer' ELSE 'Credit card' END AS payment_method,
             CASE WHEN c_nationkey % 5 < 2 THEN 'DSL' WHEN c_nationkey % 5 < 4 THEN 'Fiber optic' ELSE 'No' END AS internet_service,
             CASE WHEN c_nationkey % 5 < 2 THEN 50 WHEN c_nationkey % 5 < 4 THEN 80 ELSE 20 END + c_acctbal / 1000 AS monthly_charges
      FROM customer) c""",
    "transactions": """
SELECT o_custkey AS customer_id, o_orderdate AS transaction_date, o_totalprice AS amount,
       CASE o_orderstatus WHEN 'F' THEN 'Payment' WHEN 'O' THEN 'Refund' ELSE 'Adjustment' END AS transaction_type
FROM orders
WHERE o_custkey % 10 < 7""",
    "support_tickets": """
SELECT user_id AS customer_id, ts AS ticket_date,
       CASE WHEN event_id % 10 < 5 THEN 'Technical' WHEN event_id % 10 < 8 THEN 'Billing' ELSE 'Service' END AS issue_type,
       value AS resolution_time_hours
FROM events
WHERE event_type = 'error'""",
    "product_usage": """
SELECT o_custkey AS customer_id, SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) / CAST(COUNT(*) * 100000 AS DOUBLE) AS avg_monthly_usage_gb,
       CASE MIN(o_orderkey) % 4 WHEN 0 THEN 'Morning' WHEN 1 THEN 'Afternoon' WHEN 2 THEN 'Evening' ELSE 'Night' END AS peak_usage_hours,
       CAST(COUNT(*) % 5 AS INT) AS streaming_services_used
FROM orders
WHERE o_custkey % 10 < 6
GROUP BY o_custkey""",
    "workload_hourly": """
SELECT date_trunc('hour', ts) AS timestamp_h,
       LEAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) / CAST(COUNT(*) * 10000 AS DOUBLE), 1) AS cpu_usage,
       LEAST(MAX(value) / 400, 1) AS memory_usage,
       SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) / CAST(COUNT(*) AS DOUBLE) AS gpu_usage,
       CAST(COUNT(*) AS BIGINT) AS job_queue_length,
       CAST(COUNT(DISTINCT user_id) AS BIGINT) AS active_jobs,
       100 AS cluster_size
FROM events
GROUP BY date_trunc('hour', ts)""",
    "workload_hourly_series": """
SELECT user_id % 4 AS series_id, date_trunc('hour', ts) AS timestamp_h,
       LEAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) / CAST(COUNT(*) * 10000 AS DOUBLE), 1) AS cpu_usage,
       LEAST(MAX(value) / 400, 1) AS memory_usage,
       SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) / CAST(COUNT(*) AS DOUBLE) AS gpu_usage,
       CAST(COUNT(*) AS BIGINT) AS job_queue_length,
       CAST(COUNT(DISTINCT user_id) AS BIGINT) AS active_jobs,
       100 AS cluster_size
FROM events
GROUP BY user_id % 4, date_trunc('hour', ts)""",
    "jobs": """
SELECT CONCAT('job-', CAST(event_id AS VARCHAR(20))) AS job_id, event_id AS job_ordinal, user_id % 10 AS request_id, user_id,
       CAST(1 + event_id % 10 AS INT) AS priority,
       CAST(10 + (event_id * 17) % 600 AS INT) AS estimated_runtime_minutes,
       CAST(1 + (event_id * 7) % 16 AS INT) AS cpu_cores_required,
       CAST(2 * (1 + (event_id * 11) % 32) AS DOUBLE) AS memory_gb_required,
       CAST(CASE WHEN event_id % 5 = 0 THEN 1 + event_id % 4 ELSE 0 END AS INT) AS gpu_count_required,
       CAST(50 * (1 + (event_id * 7) % 16) AS DOUBLE) AS power_watts_estimated,
       CAST(1 + event_id % 10 AS DOUBLE) AS network_bandwidth_gbps,
       CASE event_type WHEN 'click' THEN 'gpu' WHEN 'view' THEN 'memory' WHEN 'error' THEN 'network' ELSE 'compute' END AS job_type,
       ts AS submission_time
FROM events""",
    "job_dependencies": """
SELECT CONCAT('job-', CAST(event_id AS VARCHAR(20))) AS job_id,
       CASE WHEN event_id % 97 = 0 THEN CONCAT('missing-', CAST(event_id AS VARCHAR(20)))
            ELSE CONCAT('job-', CAST(event_id - 1 AS VARCHAR(20))) END AS dependency_id
FROM events
WHERE event_id > 0 AND (event_id % 4 = 0 OR event_id % 97 = 0)""",
    "nodes": """
SELECT CONCAT('node-', CAST(s_suppkey AS VARCHAR(20))) AS node_id, s_suppkey AS node_ordinal, s_suppkey % 10 AS request_id,
       CAST(64 + 16 * (s_suppkey % 5) AS INT) AS total_cpu_cores, CAST(48 + 16 * (s_suppkey % 5) AS INT) AS available_cpu_cores,
       CAST(256 + 64 * (s_suppkey % 4) AS DOUBLE) AS total_memory_gb, CAST(192 + 64 * (s_suppkey % 4) AS DOUBLE) AS available_memory_gb,
       CAST(s_suppkey % 9 AS INT) AS total_gpu_count, CAST(s_suppkey % 9 AS INT) AS available_gpu_count,
       CAST(4000 + 500 * (s_suppkey % 3) AS DOUBLE) AS available_power_watts,
       CAST(40 + 10 * (s_suppkey % 4) AS DOUBLE) AS available_network_bandwidth_gbps,
       (50 + s_suppkey % 50) / CAST(100 AS DOUBLE) AS node_efficiency_score,
       s_suppkey % 13 <> 0 AS is_available
FROM supplier""",
    "user_quotas": """
SELECT DISTINCT user_id, CAST(1 + user_id % 3 AS INT) AS user_priority,
       CAST(40 + user_id % 40 AS INT) AS max_cpu_cores, CAST(400 AS DOUBLE) AS max_memory_gb, CAST(5 + user_id % 5 AS INT) AS max_concurrent_jobs
FROM events
WHERE user_id % 2 = 0""",
    "gateway_requests": """
SELECT event_id AS request_id, ts, user_id AS client_id,
       CASE event_type WHEN 'view' THEN '/api/v1/predict' WHEN 'click' THEN '/api/v1/optimize' WHEN 'purchase' THEN '/api/v1/schedule'
            WHEN 'signup' THEN '/api/v1/workflow/full-optimization' ELSE '/api/v1/workflow/prediction-and-schedule' END AS path,
       CASE WHEN event_id % 3 = 0 THEN 'GET' ELSE 'POST' END AS method,
       CAST(CASE WHEN event_id % 20 = 0 THEN 503 WHEN event_id % 20 = 1 THEN 429 ELSE 200 END AS INT) AS status,
       value / 50 AS latency_seconds
FROM events""",
    "health_checks": """
SELECT CASE event_id % 3 WHEN 0 THEN 'workload-predictor' WHEN 1 THEN 'resource-optimizer' ELSE 'scheduler-optimizer' END AS service,
       CASE WHEN value > 100 THEN 'unhealthy' ELSE 'healthy' END AS status, ts, CAST(FLOOR(value) AS BIGINT) AS latency_ms
FROM events""",
    "churn_scores": """
SELECT c_custkey AS customer_id, CAST((c_custkey * 37) % 101 AS DOUBLE) / 100 AS churn_probability,
       CAST(CASE WHEN (c_custkey * 37) % 101 + (c_custkey * 53) % 60 > 80 THEN 1 ELSE 0 END AS INT) AS churn
FROM customer""",
}


def with_fixtures(sql: str, names) -> str:
    """Prefix ``sql`` with the named fixture derivations as CTEs."""
    ctes = ",\n".join(f"{n} AS ({FIXTURE_SQL[n].strip()})" for n in names)
    return f"WITH RECURSIVE {ctes}\n{sql}"
