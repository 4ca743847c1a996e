"""Structured Streaming queries: file-source streams run to completion, then read back."""

from __future__ import annotations

from halyard.operators.gateway import LATENCY_BUCKETS
from halyard.plans.q_gateway import R_CTE, SERVICE_SQL
from halyard.plans.registry import R, register, round_doubles
from halyard.streaming import gateway as SG
from halyard.streaming.runner import stream_table

GW = ("gateway_requests",)
HC = ("health_checks",)
# FIXTURES: the accepted-only limiter is exercised with a 24 h window and a limit of 4.
TEST_RATE_WINDOW_S, TEST_RATE_LIMIT = 24 * 3600, 4
# The supplied files may come in any order, each with rows of all times: decisions wait for rows as late as this.
ANY_ORDER = "4000 days"


def events(spark, sf):
    return stream_table(spark, sf, "events")


def _held_sql(src: str, keys: list[str], minutes: int) -> str:
    conds = []
    for i in range(1, minutes + 1):
        on = " AND ".join([f"x.{k} = b.{k}" for k in keys] + [f"x.window_start = b.window_start - INTERVAL {i} MINUTE"])
        conds.append(f"EXISTS (SELECT 1 FROM {src} x WHERE {on} AND x.firing)")
    return "b.firing AND " + " AND ".join(conds)


@register("stream_request_counters", R_CTE + """
SELECT date_trunc('minute', ts) AS window_start, service, method, status, COUNT(*) AS n_requests,
       COUNT(*) FILTER (WHERE status >= 400) AS n_errors FROM r GROUP BY 1, 2, 3, 4""", fixtures=GW)
def q_stream_request_counters(spark, sf):
    return SG.stream_request_counters(events(spark, sf), spark)


@register("stream_error_rate_alert", f"""
, w AS (SELECT date_trunc('minute', ts) - k * INTERVAL 1 MINUTE AS window_start, status FROM gateway_requests, range(0, 5) t(k)),
b0 AS (SELECT window_start, COUNT(*) FILTER (WHERE status >= 400) AS n_errors FROM w GROUP BY 1),
bb AS (SELECT *, CAST(n_errors AS DOUBLE) / 300.0 AS error_rate, CAST(n_errors AS DOUBLE) / 300.0 > 0.1 AS firing FROM b0)
SELECT b.window_start, b.n_errors, {R('b.error_rate')} AS error_rate, b.firing, {_held_sql('bb', [], 2)} AS held FROM bb b""",
          fixtures=GW)
def q_stream_error_rate_alert(spark, sf):
    return round_doubles(SG.stream_error_rate_alert(events(spark, sf), spark))


def _latency_sql():
    n = len(LATENCY_BUCKETS)
    cols = [f"COUNT(*) FILTER (WHERE latency_seconds <= {le}) AS b{i}" for i, le in enumerate(LATENCY_BUCKETS)]
    cols.append(f"COUNT(*) AS b{n}")
    cases = []
    for i in range(n + 1):
        prev_le = LATENCY_BUCKETS[i - 1] if i > 0 else 0.0
        prev_c = f"b{i - 1}" if i > 0 else "0"
        rank = f"b{n} * 0.95"
        if i < n:
            val = f"{prev_le} + ({LATENCY_BUCKETS[i]} - {prev_le}) * (({rank} - {prev_c}) / NULLIF(b{i} - {prev_c}, 0))"
        else:
            val = f"{prev_le}"
        cases.append(f"WHEN b{i} >= {rank} THEN {val}")
    return f"""
, r AS (SELECT *, {SERVICE_SQL} AS service FROM gateway_requests),
w AS (SELECT date_trunc('minute', ts) - k * INTERVAL 1 MINUTE AS window_start, service, latency_seconds FROM r, range(0, 5) t(k)),
c AS (SELECT window_start, service, {', '.join(cols)} FROM w GROUP BY 1, 2),
p AS (SELECT window_start, service, CAST(CASE {' '.join(cases)} END AS DOUBLE) AS p95_seconds FROM c),
bb AS (SELECT *, COALESCE(p95_seconds, 0.0) > 5.0 AS firing FROM p)
SELECT b.window_start, b.service, {R('b.p95_seconds')} AS p95_seconds, b.firing, {_held_sql('bb', ['service'], 2)} AS held FROM bb b"""


@register("stream_latency_alert", _latency_sql(), fixtures=GW)
def q_stream_latency_alert(spark, sf):
    return round_doubles(SG.stream_latency_alert(events(spark, sf), spark))


@register("stream_service_down", """
SELECT date_trunc('minute', ts) AS window_start, service, COUNT(*) AS n_samples,
       MAX(CASE WHEN status = 'healthy' THEN 1 ELSE 0 END) AS max_up,
       MAX(CASE WHEN status = 'healthy' THEN 1 ELSE 0 END) = 0 AS down
FROM health_checks GROUP BY 1, 2""", fixtures=HC)
def q_stream_service_down(spark, sf):
    return SG.stream_service_down(events(spark, sf), spark)


@register("stream_restart_alert", f"""
, w AS (SELECT date_trunc('minute', ts) - k * INTERVAL 1 MINUTE AS window_start, service, status FROM health_checks, range(0, 15) t(k)),
bb AS (SELECT window_start, service, COUNT(*) FILTER (WHERE status <> 'healthy') AS restarts,
       COUNT(*) FILTER (WHERE status <> 'healthy') > 0 AS firing FROM w GROUP BY 1, 2)
SELECT b.window_start, b.service, b.restarts, b.firing, {_held_sql('bb', ['service'], 5)} AS held FROM bb b""", fixtures=HC)
def q_stream_restart_alert(spark, sf):
    return SG.stream_restart_alert(events(spark, sf), spark)


@register("stream_health_state", """
SELECT service, status, ts, latency_ms FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY service ORDER BY ts DESC, status DESC, latency_ms DESC) AS rn FROM health_checks) x
WHERE rn = 1""", fixtures=HC)
def q_stream_health_state(spark, sf):
    return SG.stream_health_state(events(spark, sf), spark)


# One request a step and client: the accepted times still inside the window, and whether the next is rejected.
_RATE_SQL = f"""
WITH RECURSIVE q AS (
  SELECT event_id AS request_id, user_id AS client_id, ts, epoch_us(ts) AS t,
         ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
step(request_id, client_id, ts, rn, kept, rejected) AS (
  SELECT request_id, client_id, ts, rn, [t], FALSE FROM q WHERE rn = 1
  UNION ALL
  SELECT q.request_id, q.client_id, q.ts, q.rn,
         CASE WHEN len(list_filter(s.kept, lambda a: q.t - a < {TEST_RATE_WINDOW_S * 1_000_000})) >= {TEST_RATE_LIMIT}
              THEN list_filter(s.kept, lambda a: q.t - a < {TEST_RATE_WINDOW_S * 1_000_000})
              ELSE list_append(list_filter(s.kept, lambda a: q.t - a < {TEST_RATE_WINDOW_S * 1_000_000}), q.t) END,
         len(list_filter(s.kept, lambda a: q.t - a < {TEST_RATE_WINDOW_S * 1_000_000})) >= {TEST_RATE_LIMIT}
  FROM step s JOIN q ON q.client_id = s.client_id AND q.rn = s.rn + 1)
SELECT request_id, client_id, ts, rejected FROM step"""


@register("stream_rate_limit", _RATE_SQL)
def q_stream_rate_limit(spark, sf):
    return SG.stream_rate_limit(events(spark, sf), spark, TEST_RATE_LIMIT, TEST_RATE_WINDOW_S, delay=ANY_ORDER)


_HOURLY_COLS = ["timestamp_h", R("cpu_usage") + " AS cpu_usage", R("memory_usage") + " AS memory_usage",
                R("gpu_usage") + " AS gpu_usage", "job_queue_length", "active_jobs", "cluster_size"]


@register("stream_workload_hourly", f"SELECT {', '.join(_HOURLY_COLS)} FROM workload_hourly", fixtures=("workload_hourly",))
def q_stream_workload_hourly(spark, sf):
    return round_doubles(SG.stream_workload_hourly(events(spark, sf), spark))


# An interval is open at the end if the stream's latest event (the millisecond after it) is past it.
@register("stream_service_absence", """
, hh AS (SELECT service, ts, LEAD(ts) OVER (PARTITION BY service ORDER BY ts) AS nxt FROM health_checks WHERE status = 'healthy'),
latest AS (SELECT MAX(epoch_us(ts)) // 1000 * 1000 + 1000 AS t FROM health_checks)
SELECT service, ts + INTERVAL 60 SECOND AS down_from, nxt AS down_until FROM hh, latest
WHERE COALESCE(epoch_us(nxt), latest.t) - epoch_us(ts) > 60000000""", fixtures=HC)
def q_stream_service_absence(spark, sf):
    return SG.stream_service_absence(events(spark, sf), spark, delay=ANY_ORDER)
