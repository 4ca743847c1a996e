"""Gateway log queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from halyard.functions import scalar as S
from halyard.operators import gateway as G
from halyard.plans.registry import R, register, round_doubles
from halyard.sources import fixtures as X

GW = ("gateway_requests",)
# FIXTURES: test traffic never reaches 100 requests/min per client, so the
# registered rate-limit query uses a 24 h window and a limit of 4.
TEST_RATE_WINDOW_S = 24 * 3600
TEST_RATE_LIMIT = 4

SERVICE_SQL = ("CASE WHEN instr(path, 'predict') > 0 THEN 'workload-predictor' "
               "WHEN instr(path, 'optimize') > 0 THEN 'resource-optimizer' "
               "WHEN instr(path, 'schedule') > 0 THEN 'scheduler-optimizer' ELSE 'gateway' END")
R_CTE = f", r AS (SELECT *, {SERVICE_SQL} AS service FROM gateway_requests)\n"
BUCKETS_SQL = ", ".join(f"({i}, CAST({le} AS DOUBLE))" for i, le in enumerate(G.LATENCY_BUCKETS)) + \
    f", ({len(G.LATENCY_BUCKETS)}, CAST(NULL AS DOUBLE))"


def reqs(spark, sf):
    return X.gateway_requests(spark, sf)


@register("service_from_path", f"SELECT request_id, path, {SERVICE_SQL} AS service FROM gateway_requests", fixtures=GW)
def q_service_from_path(spark, sf):
    return reqs(spark, sf).select("request_id", "path", S.service_from_path(F.col("path")).alias("service"))


@register("error_flag", "SELECT request_id, status, status >= 400 AS is_error FROM gateway_requests", fixtures=GW)
def q_error_flag(spark, sf):
    return reqs(spark, sf).select("request_id", "status", S.error_flag(F.col("status")).alias("is_error"))


@register("request_counters", R_CTE + """
SELECT service, method, status, COUNT(*) AS n_requests, COUNT(*) FILTER (WHERE status >= 400) AS n_errors
FROM r GROUP BY ROLLUP (service, method, status)""", fixtures=GW)
def q_request_counters(spark, sf):
    return G.request_counters(reqs(spark, sf))


_HIST_SQL = R_CTE + f""", b AS (SELECT * FROM (VALUES {BUCKETS_SQL}) v(bucket, le))
SELECT service, bucket, le, COUNT(*) FILTER (WHERE le IS NULL OR latency_seconds <= le) AS cumulative_count
FROM r CROSS JOIN b GROUP BY service, bucket, le"""


@register("latency_histogram", _HIST_SQL, fixtures=GW)
def q_latency_histogram(spark, sf):
    return G.latency_histogram(reqs(spark, sf))


_P95_SQL = _HIST_SQL.replace(R_CTE, R_CTE, 1).replace("SELECT service, bucket, le, COUNT", ", h AS (SELECT service, bucket, le, COUNT", 1) + f""")
, h2 AS (SELECT *, COALESCE(LAG(cumulative_count) OVER (PARTITION BY service ORDER BY bucket), 0) AS pc,
                COALESCE(LAG(le) OVER (PARTITION BY service ORDER BY bucket), 0.0) AS pl,
                MAX(cumulative_count) OVER (PARTITION BY service) AS total FROM h),
hit AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY service ORDER BY bucket) AS rn FROM h2
        WHERE cumulative_count >= total * 0.95 AND total > 0),
hq AS (SELECT service, CASE WHEN le IS NULL THEN pl
              ELSE pl + (le - pl) * ((total * 0.95 - pc) / NULLIF(cumulative_count - pc, 0)) END AS hp FROM hit WHERE rn = 1),
ex AS (SELECT service, quantile_cont(latency_seconds, 0.95) AS ep FROM r GROUP BY service)
SELECT ex.service, {R('ex.ep')} AS exact_p95, {R('hq.hp')} AS histogram_p95 FROM ex LEFT JOIN hq ON ex.service = hq.service"""


@register("latency_p95", _P95_SQL, fixtures=GW)
def q_latency_p95(spark, sf):
    return round_doubles(G.latency_quantiles(reqs(spark, sf), 0.95))


_RATE_SQL = f"""
, g AS (SELECT request_id, client_id, ts, epoch_us(ts) AS t FROM gateway_requests),
c AS (SELECT request_id, client_id, ts,
        COUNT(*) OVER (PARTITION BY client_id ORDER BY t RANGE BETWEEN {TEST_RATE_WINDOW_S * 1_000_000 - 1} PRECEDING AND CURRENT ROW)
        - COUNT(*) OVER (PARTITION BY client_id, t ORDER BY request_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        AS prior_in_window FROM g)
SELECT request_id, client_id, ts, prior_in_window, prior_in_window >= {TEST_RATE_LIMIT} AS rejected FROM c"""


@register("rate_limit_flags", _RATE_SQL, fixtures=GW)
def q_rate_limit_flags(spark, sf):
    out = G.rate_limit_flags(reqs(spark, sf), limit=TEST_RATE_LIMIT, window_seconds=TEST_RATE_WINDOW_S)
    return out.select("request_id", "client_id", "ts", "prior_in_window", "rejected")


_SVC_VALUES = ", ".join(f"('{s}')" for s in G.SERVICES)
_HEALTH_SQL = f"""
, last AS (SELECT service, status, ts, latency_ms FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY service ORDER BY ts DESC, status DESC, latency_ms DESC) AS rn
    FROM health_checks) x WHERE rn = 1),
conf AS (SELECT * FROM (VALUES {_SVC_VALUES}) v(service)),
per AS (SELECT conf.service, last.status, last.ts, last.latency_ms FROM conf LEFT JOIN last ON conf.service = last.service)
SELECT per.*, (SELECT CASE WHEN COUNT(*) FILTER (WHERE status IS NULL OR status <> 'healthy') > 0
                      THEN 'degraded' ELSE 'healthy' END FROM per) AS overall_status FROM per"""


@register("latest_health", _HEALTH_SQL, fixtures=("health_checks",))
def q_latest_health(spark, sf):
    return G.latest_health(X.health_checks(spark, sf), spark)
