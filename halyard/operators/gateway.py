"""Request-log analytics: counters, latency histogram, rate limiting, health state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from halyard.functions.scalar import error_flag, service_from_path
from halyard.operators.quantiles import exact_quantiles, quantile_name

# Fixed values that must equal the reference's.
# Prometheus default histogram buckets (seconds), followed by +Inf.
LATENCY_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]
RATE_LIMIT = 100              # requests per client per window
RATE_WINDOW_SECONDS = 60
SERVICES = ["workload-predictor", "resource-optimizer", "scheduler-optimizer"]

US = 1_000_000


def with_service(df: DataFrame, path: str = "path") -> DataFrame:
    return df.withColumn("service", service_from_path(F.col(path)))


def request_counters(requests: DataFrame) -> DataFrame:
    """Requests and errors by service x method x status with rollup subtotals and grand total."""
    r = with_service(requests)
    return r.rollup("service", "method", "status").agg(
        F.count(F.lit(1)).alias("n_requests"),
        F.count_if(error_flag(F.col("status"))).alias("n_errors"))


def latency_histogram(requests: DataFrame, latency: str = "latency_seconds", by: str = "service") -> DataFrame:
    """Cumulative bucket counts per ``by``: one row per bucket, ``le`` NULL for +Inf."""
    r = with_service(requests) if by == "service" and "service" not in requests.columns else requests
    aggs = [F.count_if(F.col(latency) <= le).alias(f"b{i}") for i, le in enumerate(LATENCY_BUCKETS)]
    aggs.append(F.count(F.lit(1)).alias(f"b{len(LATENCY_BUCKETS)}"))
    wide = r.groupBy(by).agg(*aggs)
    n = len(LATENCY_BUCKETS) + 1
    stack = ", ".join(f"{i}, CAST({LATENCY_BUCKETS[i] if i < len(LATENCY_BUCKETS) else 'NULL'} AS DOUBLE), b{i}"
                      for i in range(n))
    return wide.selectExpr(by, f"stack({n}, {stack}) AS (bucket, le, cumulative_count)")


def histogram_quantile(hist: DataFrame, q: float, by: str = "service") -> DataFrame:
    """Prometheus ``histogram_quantile`` over cumulative buckets (linear inside the bucket)."""
    w = Window.partitionBy(by).orderBy("bucket")
    h = (hist.withColumn("prev_count", F.coalesce(F.lag("cumulative_count").over(w), F.lit(0)))
         .withColumn("prev_le", F.coalesce(F.lag("le").over(w), F.lit(0.0)))
         .withColumn("total", F.max("cumulative_count").over(Window.partitionBy(by))))
    rank = F.col("total") * q
    hit = h.where((F.col("cumulative_count") >= rank) & (F.col("total") > 0))
    first = hit.groupBy(by).agg(F.min("bucket").alias("bucket"))
    b = hit.join(first, [by, "bucket"])
    inside = F.col("prev_le") + (F.col("le") - F.col("prev_le")) * \
        F.try_divide(rank - F.col("prev_count"), F.col("cumulative_count") - F.col("prev_count"))
    value = F.when(F.col("le").isNull(), F.col("prev_le")).otherwise(inside)
    return b.select(by, value.alias(f"histogram_p{int(q * 100)}"))


def latency_quantiles(requests: DataFrame, q: float = 0.95, latency: str = "latency_seconds") -> DataFrame:
    """Exact (interpolated) quantile and the bucket-interpolated one per service."""
    r = with_service(requests)
    exact = exact_quantiles(r, latency, [q], by=["service"]).withColumnRenamed(quantile_name(q), f"exact_p{int(q * 100)}")
    return exact.join(histogram_quantile(latency_histogram(r), q), "service", "left")


def rate_limit_flags(requests: DataFrame, limit: int = RATE_LIMIT, window_seconds: int = RATE_WINDOW_SECONDS,
                     client: str = "client_id", ts: str = "ts", order: str = "request_id",
                     block_seconds: int | None = None) -> DataFrame:
    """Offered-load rate limit: reject when ``limit`` earlier requests of the client fall in the open window.

    Earlier = strictly inside (ts - window, ts], plus same-timestamp requests
    ordered before this one.  Rows are partitioned by (client, time block);
    each block also receives the previous block's last window of rows, so a
    hot client is spread over many tasks and the counts stay exact.
    """
    win_us = window_seconds * US
    blk_us = (block_seconds or max(3600, 16 * window_seconds)) * US  # overlap is 1/16 of a block
    t_us = F.unix_micros(F.col(ts).cast("timestamp"))
    base = requests.withColumn("_t", t_us).withColumn("_blk", F.floor(F.col("_t") / blk_us)).withColumn("_own", F.lit(True))
    carry = (base.where(F.col("_t") - F.col("_blk") * blk_us >= blk_us - win_us)
             .withColumn("_blk", F.col("_blk") + 1).withColumn("_own", F.lit(False)))
    both = base.unionByName(carry)
    w = Window.partitionBy(client, "_blk").orderBy("_t").rangeBetween(-(win_us - 1), 0)
    same = Window.partitionBy(client, "_blk", "_t").orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, 0)
    counted = both.select("*", (F.count(F.lit(1)).over(w) - F.count(F.lit(1)).over(same)).alias("prior_in_window"))
    return (counted.where(F.col("_own"))
            .withColumn("rejected", F.col("prior_in_window") >= limit)
            .drop("_t", "_blk", "_own"))


def latest_health(checks: DataFrame, spark: SparkSession, services=None) -> DataFrame:
    """Last health sample per configured service and the overall state (degraded if any missing / unhealthy)."""
    services = services or SERVICES
    last = checks.groupBy("service").agg(F.max(F.struct("ts", "status", "latency_ms")).alias("_l")).select(
        "service", F.col("_l.status").alias("status"), F.col("_l.ts").alias("ts"), F.col("_l.latency_ms").alias("latency_ms"))
    # configured service list: a handful of names, bounded by configuration
    conf = spark.createDataFrame([(s,) for s in services], "service string")
    per = conf.join(last, "service", "left")
    overall = per.agg(F.when(F.count_if(F.col("status").isNull() | (F.col("status") != "healthy")) > 0, "degraded")
                      .otherwise("healthy").alias("overall_status"))
    return per.crossJoin(F.broadcast(overall))
