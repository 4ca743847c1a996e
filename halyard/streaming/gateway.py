"""Structured Streaming versions of the gateway and alerting operators.

Each function takes a *streaming* events DataFrame and returns the final
table after the stream has consumed its input (see ``runner``).  Counters keep
only open windows from batch to batch (``delay`` behind the latest event) and
late rows in a table of their own.  Alert "for" durations (held for k minutes) are evaluated on the small windowed
result with equi self-joins on shifted window starts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halyard.functions.scalar import error_flag
from halyard.operators.gateway import LATENCY_BUCKETS, RATE_LIMIT, RATE_WINDOW_SECONDS, with_service
from halyard.sources import fixtures as X
from halyard.streaming.runner import DELAY, run_processor, run_update, run_windows, with_event_time
from halyard.streaming.stateful import DECIDED, SILENT, RateLimiter, SilenceWatch

# Fixed values that must equal the reference's alert rules.
ERROR_RATE_PER_S, ERROR_WINDOW_MIN, ERROR_HOLD_MIN = 0.1, 5, 2
LATENCY_P95_S, LATENCY_HOLD_MIN = 5.0, 2
RESTART_WINDOW_MIN, RESTART_HOLD_MIN = 15, 5
MINUTE = "1 minute"


def _count(condition: Column) -> tuple[str, Column]:
    return "sum", F.when(condition, 1).otherwise(0).cast("bigint")


def sliding(minutes: DataFrame, keys: list[str], length: int, sums: list[str]) -> DataFrame:
    """Windows of ``length`` minutes, one each minute, from the stream's minute counts.

    The stream keeps one row a minute and key; only these rows, not the events, go into several windows.
    """
    back = F.explode(F.sequence(F.lit(0), F.lit(length - 1))).alias("_k")
    rows = minutes.select(*keys, "window_start", *sums, back)
    start = F.timestamp_add("MINUTE", -F.col("_k"), F.col("window_start")).alias("window_start")
    return rows.select(*keys, start, *sums).groupBy("window_start", *keys).agg(*[F.sum(c).alias(c) for c in sums])


def held(df: DataFrame, keys: list[str], minutes: int, flag: str = "firing") -> DataFrame:
    """``held``: the flag is true at this evaluation and the ``minutes`` one-minute evaluations before it."""
    fired = df.where(F.col(flag)).select(*keys, "window_start")
    out = df
    for i in range(1, minutes + 1):
        shifted = fired.select(*keys, F.timestamp_add("MINUTE", F.lit(i), F.col("window_start")).alias("window_start"),
                               F.lit(True).alias(f"_h{i}"))
        out = out.join(shifted, keys + ["window_start"], "left")
    cond = F.col(flag)
    for i in range(1, minutes + 1):
        cond = cond & F.col(f"_h{i}").isNotNull()
    return out.withColumn("held", cond).drop(*[f"_h{i}" for i in range(1, minutes + 1)])


def stream_request_counters(events: DataFrame, spark=None, delay: str = DELAY) -> DataFrame:
    r = with_event_time(with_service(X.gateway_requests(spark, "", src=events)))
    aggs = {"n_requests": _count(F.lit(True)), "n_errors": _count(error_flag(F.col("status")))}
    return run_windows(r, MINUTE, ["service", "method", "status"], aggs, "counters", delay)


def stream_error_rate_alert(events: DataFrame, spark=None, delay: str = DELAY) -> DataFrame:
    r = with_event_time(X.gateway_requests(spark, "", src=events))
    minutes = run_windows(r, MINUTE, [], {"n_errors": _count(error_flag(F.col("status")))}, "error-rate", delay)
    out = sliding(minutes, [], ERROR_WINDOW_MIN, ["n_errors"])
    rate = out.withColumn("error_rate", F.col("n_errors") / 300.0) \
        .withColumn("firing", F.col("error_rate") > ERROR_RATE_PER_S)
    return held(rate, [], ERROR_HOLD_MIN)


def quantile_from_buckets(q: float, counts: list[str], total: str) -> Column:
    """Prometheus histogram_quantile over cumulative bucket columns (last = +Inf)."""
    rank = F.col(total) * q
    expr = None
    for i, c in enumerate(counts):
        prev_le = LATENCY_BUCKETS[i - 1] if i > 0 else 0.0
        prev_c = F.col(counts[i - 1]) if i > 0 else F.lit(0)
        if i < len(LATENCY_BUCKETS):
            val = F.lit(prev_le) + (LATENCY_BUCKETS[i] - prev_le) * F.try_divide(rank - prev_c, F.col(c) - prev_c)
        else:
            val = F.lit(prev_le)
        cond = F.col(c) >= rank
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr


def stream_latency_alert(events: DataFrame, spark=None, delay: str = DELAY) -> DataFrame:
    r = with_event_time(with_service(X.gateway_requests(spark, "", src=events)))
    names = [f"b{i}" for i in range(len(LATENCY_BUCKETS) + 1)]
    aggs = {names[i]: _count(F.col("latency_seconds") <= le) for i, le in enumerate(LATENCY_BUCKETS)} | {names[-1]: _count(F.lit(True))}
    out = sliding(run_windows(r, MINUTE, ["service"], aggs, "latency", delay), ["service"], ERROR_WINDOW_MIN, names)
    p95 = out.withColumn("p95_seconds", quantile_from_buckets(0.95, names, names[-1]))
    flagged = p95.select("window_start", "service", "p95_seconds",
                         (F.coalesce(F.col("p95_seconds"), F.lit(0.0)) > LATENCY_P95_S).alias("firing"))
    return held(flagged, ["service"], LATENCY_HOLD_MIN)


def stream_service_down(events: DataFrame, spark=None, delay: str = DELAY) -> DataFrame:
    h = with_event_time(X.health_checks(spark, "", src=events))
    aggs = {"n_samples": _count(F.lit(True)), "max_up": ("max", (F.col("status") == "healthy").cast("int"))}
    return run_windows(h, MINUTE, ["service"], aggs, "down", delay).withColumn("down", F.col("max_up") == 0)


def stream_restart_alert(events: DataFrame, spark=None, delay: str = DELAY) -> DataFrame:
    """Restarts = unhealthy samples; rate over 15 min > 0 held for 5 min."""
    h = with_event_time(X.health_checks(spark, "", src=events))
    minutes = run_windows(h, MINUTE, ["service"], {"restarts": _count(F.col("status") != "healthy")}, "restarts", delay)
    out = sliding(minutes, ["service"], RESTART_WINDOW_MIN, ["restarts"])
    return held(out.withColumn("firing", F.col("restarts") > 0), ["service"], RESTART_HOLD_MIN)


def stream_health_state(events: DataFrame, spark=None) -> DataFrame:
    h = with_event_time(X.health_checks(spark, "", src=events))
    agg = h.groupBy("service").agg(F.max(F.struct("ts", "status", "latency_ms")).alias("_l"))
    out = run_update(agg.select("service", F.col("_l.status").alias("status"),
                                F.col("_l.ts").cast("timestamp_ntz").alias("ts"),
                                F.col("_l.latency_ms").alias("latency_ms")), ["service"], "health")
    return out


def stream_rate_limit(events: DataFrame, spark=None, limit: int = RATE_LIMIT,
                      window_seconds: int = RATE_WINDOW_SECONDS, delay: str = DELAY) -> DataFrame:
    """Accepted-only sliding log per client (rejected requests do not count), decided while the stream runs.

    A request waits until the watermark has passed it, then its client's requests are decided in event-time order, so
    they may come in any order within ``delay``.  A client's state is the waiting requests and at most ``limit`` times.
    """
    out, _ = run_processor(events, lambda e: X.gateway_requests(spark, "", src=e).select("request_id", "client_id", "ts"), "client_id",
                           RateLimiter(limit, window_seconds * 1_000_000), DECIDED, delay, name="rate-limit")
    return out.select("request_id", "client_id", F.timestamp_micros("t_us").cast("timestamp_ntz").alias("ts"), "rejected")


def stream_workload_hourly(events: DataFrame, spark=None, delay: str = DELAY) -> DataFrame:
    """Hourly telemetry rows from the event stream; what is carried is one row an open hour and user."""
    e = with_event_time(events)
    aggs = {"c_cents": ("sum", F.round(F.col("value") * 100).cast("bigint")), "c_n": _count(F.lit(True)), "c_vmax": ("max", F.col("value")),
            "c_clicks": _count(F.col("event_type") == "click")}
    users = run_windows(e, "1 hour", ["user_id"], aggs, "hourly", delay).withColumnRenamed("window_start", "timestamp_h")
    out = users.groupBy("timestamp_h").agg(
        F.sum("c_cents").alias("_cents"), F.sum("c_n").alias("_n"), F.max("c_vmax").alias("_vmax"),
        F.sum("c_clicks").alias("_clicks"), F.count("user_id").alias("_users"))
    return out.select(
        "timestamp_h",
        F.least(F.col("_cents") / (F.col("_n") * 10000).cast("double"), F.lit(1.0)).alias("cpu_usage"),
        F.least(F.col("_vmax") / 400, F.lit(1.0)).alias("memory_usage"),
        (F.col("_clicks") / F.col("_n").cast("double")).alias("gpu_usage"),
        F.col("_n").cast("bigint").alias("job_queue_length"),
        F.col("_users").cast("bigint").alias("active_jobs"), F.lit(100).alias("cluster_size"))


def stream_service_absence(events: DataFrame, spark=None, gap_seconds: int = 60, delay: str = DELAY) -> DataFrame:
    """Down intervals: no healthy sample of a service for more than ``gap_seconds``.

    A timer per service reports the interval while the service is silent (down_until null) and again with its end when
    a healthy sample comes; the last word on each interval is returned.  One still open at the end stays null.
    """
    reported, _ = run_processor(events, lambda e: X.health_checks(spark, "", src=e).select("service", "status", "ts"), "service",
                                SilenceWatch(gap_seconds * 1_000_000), SILENT, delay, name="absence")
    last = reported.groupBy("service", "from_us").agg(F.max("until_us").alias("until_us"))
    return last.select("service", F.timestamp_micros("from_us").cast("timestamp_ntz").alias("down_from"),
                       F.timestamp_micros("until_us").cast("timestamp_ntz").alias("down_until"))
