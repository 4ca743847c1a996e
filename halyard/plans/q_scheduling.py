"""Job scheduling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from halyard.operators import scheduling as SC
from halyard.operators.prefix import running_totals
from halyard.plans.placement_sql import placement_ctes, quota_ctes
from halyard.plans.registry import R, register, round_doubles
from halyard.sources import fixtures as X

FIX = ("jobs", "nodes", "user_quotas")

SQL_DIMS = [("cpu_cores_required", "available_cpu_cores", "used_cpu", "INT"),
            ("memory_gb_required", "available_memory_gb", "used_memory", "DOUBLE"),
            ("gpu_count_required", "available_gpu_count", "used_gpu", "INT")]

BASE_CTES = """
, sc_jobs0 AS (SELECT request_id, job_id, job_ordinal, user_id, priority, estimated_runtime_minutes, cpu_cores_required,
       memory_gb_required, gpu_count_required, submission_time, CAST(NULL AS TIMESTAMP) AS earliest_start_time FROM jobs)
, sc_ujc AS (SELECT request_id, user_id, COUNT(*) AS user_job_count FROM sc_jobs0 GROUP BY request_id, user_id)
, sc_jobs AS (SELECT j.*, COALESCE(q.user_priority, 1) AS user_priority, q.max_cpu_cores, q.max_memory_gb,
       q.max_concurrent_jobs, u.user_job_count,
       CAST(-j.priority * COALESCE(q.user_priority, 1) AS DOUBLE) / u.user_job_count AS fair_key
  FROM sc_jobs0 j LEFT JOIN user_quotas q ON j.user_id = q.user_id
  JOIN sc_ujc u ON j.request_id = u.request_id AND j.user_id = u.user_id)
, sc_state AS (SELECT request_id, node_id, node_ordinal, is_available, total_cpu_cores, total_memory_gb, total_gpu_count,
       available_cpu_cores, available_memory_gb, available_gpu_count, CAST(0 AS INT) AS used_cpu,
       CAST(0 AS DOUBLE) AS used_memory, CAST(0 AS INT) AS used_gpu, CAST(0 AS BIGINT) AS n_placed FROM nodes)
, sc_now AS (SELECT MAX(submission_time) AS now FROM jobs)"""

ORDER_SQL = {
    "fifo": "submission_time ASC, job_ordinal ASC",
    "sjf": "estimated_runtime_minutes ASC, job_ordinal ASC",
    "priority": "priority DESC, submission_time ASC, job_ordinal ASC",
    "backfill": ("CASE WHEN priority >= 7 THEN 0 ELSE 1 END ASC, "
                 "CASE WHEN priority >= 7 THEN -priority ELSE estimated_runtime_minutes END ASC, job_ordinal ASC"),
    "fair_share": "fair_key ASC, submission_time ASC, job_ordinal ASC",
}
SCORE_SQL = ("COALESCE((1.0 - ABS(cpu_cores_required / (available_cpu_cores - used_cpu) - "
             "memory_gb_required / (available_memory_gb - used_memory))) * 0.6 + "
             "(CASE WHEN n_placed = 0 THEN 1.0 ELSE 0.5 END) * 0.4, 0.0)")


def schedule_sql(policy: str) -> str:
    """CTEs ending in ``{tag}_sched`` (the schedule rows) for ``policy``."""
    tag = f"s_{policy[:4]}"
    ctes = placement_ctes("sc_jobs", "sc_state", SQL_DIMS, ORDER_SQL[policy], SCORE_SQL, extra_sql="s.is_available", tag=tag,
                          quotas=policy == "fair_share")
    return ctes + f""",
{tag}_tl AS (SELECT p.*, CAST(SUM(estimated_runtime_minutes) OVER w AS BIGINT) AS cum_min,
       CAST(ROW_NUMBER() OVER w - 1 AS INTEGER) AS queue_position FROM {tag}_placements p
  WINDOW w AS (PARTITION BY request_id, node_id ORDER BY queue_rank
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
{tag}_sched AS (SELECT request_id, job_id, node_id,
       now + to_minutes(cum_min - estimated_runtime_minutes) AS scheduled_start_time,
       now + to_minutes(cum_min) AS estimated_completion_time, cpu_cores_required AS allocated_cpu_cores,
       memory_gb_required AS allocated_memory_gb, gpu_count_required AS allocated_gpu_count, queue_position
  FROM {tag}_tl, sc_now)"""


SCHED_COLS = ["request_id", "job_id", "node_id", "scheduled_start_time", "estimated_completion_time",
              "allocated_cpu_cores", "allocated_memory_gb", "allocated_gpu_count", "queue_position"]


def inputs(spark, sf):
    return X.jobs(spark, sf), X.nodes(spark, sf), X.user_quotas(spark, sf)


def run_policy(spark, sf, policy):
    j, n, q = inputs(spark, sf)
    out, _, _ = SC.schedule(j, n, q, policy)
    return out, j, n


def _fair_jobs(spark, sf):
    j, _, q = inputs(spark, sf)
    return SC.with_fair_key(SC.scheduler_jobs(j), q)


# ---- orders, quotas --------------------------------------------------------------------

def _order_query(policy):
    sql = BASE_CTES + f"""
SELECT request_id, job_id, ROW_NUMBER() OVER (PARTITION BY request_id ORDER BY {ORDER_SQL[policy]}) AS queue_rank FROM sc_jobs"""

    def fn(spark, sf):
        ranked = running_totals(_fair_jobs(spark, sf), ["request_id"], SC.queue_order(policy), rank_col="queue_rank")
        return ranked.select("request_id", "job_id", "queue_rank")
    register(f"order_{policy}", sql, fixtures=FIX)(fn)


for _p in SC.POLICIES:
    _order_query(_p)


@register("priority_split", """
SELECT request_id, job_id, priority, CASE WHEN priority >= 7 THEN 'priority' ELSE 'regular' END AS priority_class FROM jobs""",
          fixtures=FIX)
def q_priority_split(spark, sf):
    return SC.priority_split(X.jobs(spark, sf))


@register("user_job_counts", "SELECT request_id, user_id, COUNT(*) AS user_job_count FROM jobs GROUP BY request_id, user_id",
          fixtures=FIX)
def q_user_job_counts(spark, sf):
    return SC.user_job_counts(X.jobs(spark, sf))


@register("quota_lookup", BASE_CTES + """
SELECT request_id, job_id, user_id, user_priority, max_cpu_cores, max_memory_gb, max_concurrent_jobs FROM sc_jobs""",
          fixtures=FIX)
def q_quota_lookup(spark, sf):
    return _fair_jobs(spark, sf).select("request_id", "job_id", "user_id", "user_priority", "max_cpu_cores",
                                        "max_memory_gb", "max_concurrent_jobs")


@register("quota_admission", BASE_CTES + quota_ctes("sc_jobs", ORDER_SQL["fair_share"], "qa") + "\nSELECT request_id, job_id, user_id FROM qa_fair",
          fixtures=FIX)
def q_quota_admission(spark, sf):
    return SC.quota_admission(_fair_jobs(spark, sf)).select("request_id", "job_id", "user_id")


_FEAS = " AND ".join(f"s.{c} >= p.{d}" for d, c, _, _ in SQL_DIMS) + " AND s.is_available"


@register("schedule_node_score", BASE_CTES + f"""
, f AS (SELECT p.request_id, p.job_id, s.node_ordinal, {SCORE_SQL} AS score
        FROM sc_jobs p JOIN sc_state s ON p.request_id = s.request_id AND {_FEAS}),
b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY job_id ORDER BY score DESC, node_ordinal) AS rn FROM f)
SELECT request_id, job_id, {R('score')} AS score FROM b WHERE rn = 1""", fixtures=FIX)
def q_schedule_node_score(spark, sf):
    j, n, _ = inputs(spark, sf)
    return round_doubles(SC.first_choice(j, n).select("request_id", "job_id", "score"))


# ---- schedules per policy ----------------------------------------------------------------

def _schedule_query(policy):
    tag = f"s_{policy[:4]}"
    sql = BASE_CTES + schedule_sql(policy) + f"\nSELECT {', '.join(SCHED_COLS)} FROM {tag}_sched"

    def fn(spark, sf):
        out, _, _ = run_policy(spark, sf, policy)
        return out.select(*SCHED_COLS)
    register(f"schedule_{policy}", sql, fixtures=FIX)(fn)


for _p in SC.POLICIES:
    _schedule_query(_p)


@register("policy_registry", BASE_CTES + schedule_sql("fair_share") + f"\nSELECT {', '.join(SCHED_COLS)} FROM s_fair_sched",
          fixtures=FIX)
def q_policy_registry(spark, sf):
    """An unknown policy name dispatches to the default (fair share)."""
    j, n, q = inputs(spark, sf)
    out, _, _ = SC.schedule(j, n, q, "no-such-policy")
    return out.select(*SCHED_COLS)


@register("node_timeline", BASE_CTES + schedule_sql("fifo") + """
SELECT request_id, job_id, node_id, scheduled_start_time, estimated_completion_time FROM s_fifo_sched""", fixtures=FIX)
def q_node_timeline(spark, sf):
    out, _, _ = run_policy(spark, sf, "fifo")
    return out.select("request_id", "job_id", "node_id", "scheduled_start_time", "estimated_completion_time")


@register("queue_position", BASE_CTES + schedule_sql("fifo") + """
SELECT request_id, job_id, node_id, queue_position FROM s_fifo_sched""", fixtures=FIX)
def q_queue_position(spark, sf):
    out, _, _ = run_policy(spark, sf, "fifo")
    return out.select("request_id", "job_id", "node_id", "queue_position")


@register("schedule_with_submission", BASE_CTES + schedule_sql("fifo") + f"""
SELECT s.request_id, s.job_id, s.scheduled_start_time, j.submission_time,
       {R("GREATEST(0.0, (epoch_us(s.scheduled_start_time) - epoch_us(j.submission_time)) / 60000000.0)")} AS wait_minutes
FROM s_fifo_sched s JOIN jobs j ON s.request_id = j.request_id AND s.job_id = j.job_id""", fixtures=FIX)
def q_schedule_with_submission(spark, sf):
    out, j, _ = run_policy(spark, sf, "fifo")
    sw = SC.schedule_with_submission(out, j)
    return round_doubles(sw.select("request_id", "job_id", "scheduled_start_time", "submission_time", "wait_minutes"))


_SUMMARY_SQL = BASE_CTES + schedule_sql("fair_share") + f""",
ws AS (SELECT s.*, GREATEST(0.0, (epoch_us(s.scheduled_start_time) - epoch_us(j.submission_time)) / 60000000.0) AS wait_minutes
       FROM s_fair_sched s JOIN jobs j ON s.request_id = j.request_id AND s.job_id = j.job_id),
tot AS (SELECT request_id, COUNT(*) AS total_jobs FROM jobs GROUP BY request_id),
cap AS (SELECT request_id, SUM(total_cpu_cores) AS c, SUM(total_memory_gb) AS m, SUM(total_gpu_count) AS g FROM nodes GROUP BY request_id),
agg AS (SELECT request_id, COUNT(*) AS n, SUM(allocated_cpu_cores) AS uc, SUM(allocated_memory_gb) AS um,
        SUM(allocated_gpu_count) AS ug, AVG(wait_minutes) AS w FROM ws GROUP BY request_id),
summ AS (SELECT t.request_id, 'fair_share' AS policy_used, t.total_jobs, COALESCE(a.n, 0) AS scheduled_count,
        COALESCE(COALESCE(a.n, 0) / NULLIF(t.total_jobs, 0), 0.0) AS scheduling_efficiency,
        COALESCE(COALESCE(a.uc, 0) / NULLIF(c.c, 0), 0.0) AS cpu_utilization,
        COALESCE(COALESCE(a.um, 0) / NULLIF(c.m, 0), 0.0) AS memory_utilization,
        COALESCE(COALESCE(a.ug, 0) / NULLIF(c.g, 0), 0.0) AS gpu_utilization,
        COALESCE(a.w, 0.0) AS average_wait_time_minutes
  FROM tot t LEFT JOIN agg a ON t.request_id = a.request_id LEFT JOIN cap c ON t.request_id = c.request_id)"""

SUMMARY_COLS = ["request_id", "policy_used", "total_jobs", "scheduled_count", "scheduling_efficiency",
                "cpu_utilization", "memory_utilization", "gpu_utilization", "average_wait_time_minutes"]


def _fair_summary(spark, sf):
    out, j, n = run_policy(spark, sf, "fair_share")
    return SC.schedule_summary(out, j, n, "fair_share")


def _summary_query(name, cols):
    sel = ", ".join(c if c in ("request_id", "policy_used", "total_jobs", "scheduled_count") else f"{R(c)} AS {c}"
                    for c in ["request_id"] + cols)
    sql = _SUMMARY_SQL + f"\nSELECT {sel} FROM summ"

    def fn(spark, sf):
        return round_doubles(_fair_summary(spark, sf).select("request_id", *cols))
    register(name, sql, fixtures=FIX)(fn)


_summary_query("schedule_summary", SUMMARY_COLS[1:])
_summary_query("scheduling_efficiency", ["scheduling_efficiency"])
_summary_query("cluster_utilization", ["cpu_utilization", "memory_utilization", "gpu_utilization"])
_summary_query("average_wait", ["average_wait_time_minutes"])


@register("unscheduled_jobs", BASE_CTES + schedule_sql("fair_share") + """
SELECT request_id, job_id FROM jobs WHERE job_id NOT IN (SELECT job_id FROM s_fair_sched)""", fixtures=FIX)
def q_unscheduled_jobs(spark, sf):
    out, j, _ = run_policy(spark, sf, "fair_share")
    return SC.unscheduled_jobs(j, out)


@register("missing_dependencies", """
SELECT j.request_id, d.job_id, d.dependency_id FROM job_dependencies d JOIN jobs j ON d.job_id = j.job_id
WHERE NOT EXISTS (SELECT 1 FROM jobs k WHERE k.request_id = j.request_id AND k.job_id = d.dependency_id)""",
          fixtures=("jobs", "job_dependencies"))
def q_missing_dependencies(spark, sf):
    return SC.missing_dependencies(X.jobs(spark, sf), X.job_dependencies(spark, sf)).select("request_id", "job_id", "dependency_id")


@register("policy_listing", BASE_CTES + "\n" + "\nUNION ALL ".join(f"""SELECT policy, description, is_default, request_id, first_job FROM (
  SELECT '{p}' AS policy, '{SC.POLICY_DESCRIPTIONS[p]}' AS description, {str(p == SC.DEFAULT_POLICY).upper()} AS is_default, request_id,
         job_id AS first_job, ROW_NUMBER() OVER (PARTITION BY request_id ORDER BY {ORDER_SQL[p]}) AS rn FROM sc_jobs) x WHERE rn = 1"""
    for p in SC.POLICIES), fixtures=FIX)
def q_policy_listing(spark, sf):
    j, _, q = inputs(spark, sf)
    return SC.policy_listing(spark, j, q)
