"""Resource allocation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from halyard.operators import allocation as A
from halyard.operators.prefix import running_totals
from halyard.operators.placement import admit
from halyard.plans.placement_sql import placement_ctes, still_fitting_sql
from halyard.plans.registry import R, register, round_doubles
from halyard.sources import fixtures as X

FIX = ("jobs", "nodes")
# FIXTURES jobs carry no start parameter; allocation times start at this instant.
ALLOC_START = "2024-02-01 00:00:00"

SQL_DIMS = [("cpu_cores_required", "available_cpu_cores", "used_cpu", "INT"),
            ("memory_gb_required", "available_memory_gb", "used_memory", "DOUBLE"),
            ("gpu_count_required", "available_gpu_count", "used_gpu", "INT"),
            ("power_watts_estimated", "available_power_watts", "used_power", "DOUBLE"),
            ("network_bandwidth_gbps", "available_network_bandwidth_gbps", "used_bandwidth", "DOUBLE")]

BASE_CTES = """
, al_jobs AS (SELECT request_id, job_id, job_ordinal, priority, CAST(estimated_runtime_minutes AS DOUBLE) / 60.0 AS runtime_hours,
       cpu_cores_required, memory_gb_required, gpu_count_required, power_watts_estimated, network_bandwidth_gbps FROM jobs)
, al_state AS (SELECT request_id, node_id, node_ordinal, node_efficiency_score, available_cpu_cores, available_memory_gb,
       available_gpu_count, available_power_watts, available_network_bandwidth_gbps, CAST(0 AS INT) AS used_cpu,
       CAST(0 AS DOUBLE) AS used_memory, CAST(0 AS INT) AS used_gpu, CAST(0 AS DOUBLE) AS used_power,
       CAST(0 AS DOUBLE) AS used_bandwidth, CAST(0 AS BIGINT) AS n_placed FROM nodes)"""

ORDER_SQL = {"efficiency": "priority DESC, runtime_hours ASC, job_ordinal ASC",
             "throughput": "cpu_cores_required + memory_gb_required ASC, job_ordinal ASC",
             "power": "power_watts_estimated ASC, job_ordinal ASC"}
NODE_SCORE_SQL = ("(1.0 - ABS((cpu_cores_required + used_cpu) / available_cpu_cores - "
                  "(memory_gb_required + used_memory) / available_memory_gb)) * 0.4 + node_efficiency_score * 0.4")
BONUS_SQL = "(CAST(priority AS DOUBLE) / 10.0) * 0.2"
SCORE_SQL = {"efficiency": NODE_SCORE_SQL, "throughput": NODE_SCORE_SQL, "power": "node_efficiency_score"}


def plan_sql(objective: str, tag: str | None = None) -> str:
    tag = tag or f"pl_{objective[:3]}"
    score = SCORE_SQL[objective] if objective == "power" else f"{SCORE_SQL[objective]} + {BONUS_SQL}"
    return placement_ctes("al_jobs", "al_state", SQL_DIMS, ORDER_SQL[objective], score, tag=tag, node_cols=("node_efficiency_score",))


def summary_sql(objective: str, tag: str | None = None) -> str:
    """CTE ``{tag}_summary``: the SQL twin of ``allocation.plan_summary``."""
    tag = tag or f"pl_{objective[:3]}"
    eff = {"efficiency": "priority_efficiency", "throughput": "throughput_score", "power": "power_efficiency"}[objective]
    return plan_sql(objective, tag) + f""",
{tag}_cap AS (SELECT request_id, SUM(available_cpu_cores) AS c, SUM(available_memory_gb) AS m, SUM(available_gpu_count) AS g,
       SUM(available_power_watts) AS pw FROM nodes GROUP BY request_id),
{tag}_use AS (SELECT request_id, COUNT(*) AS n_placed, SUM(priority) AS prio, SUM(priority * runtime_hours) AS work,
       SUM(power_watts_estimated) AS power, MAX(runtime_hours) AS mk, SUM(cpu_cores_required) AS uc,
       SUM(memory_gb_required) AS um, SUM(gpu_count_required) AS ug FROM {tag}_placements GROUP BY request_id),
{tag}_sub AS (SELECT request_id, COUNT(*) AS n_jobs, SUM(priority) AS prio_all FROM al_jobs GROUP BY request_id),
{tag}_t AS (SELECT b.request_id, b.n_jobs, COALESCE(u.n_placed, 0) AS n_placed,
       CASE WHEN COALESCE(u.n_placed, 0) = 0 THEN 0.0 ELSE LEAST(1.0, COALESCE(u.prio / NULLIF(b.prio_all, 0), 0.0)) END AS priority_efficiency,
       COALESCE(COALESCE(u.n_placed, 0) / NULLIF(b.n_jobs, 0), 0.0) AS throughput_score,
       CASE WHEN COALESCE(u.n_placed, 0) = 0 THEN 0.0 ELSE COALESCE(u.work / NULLIF(u.power, 0), 0.0) END AS power_efficiency,
       COALESCE(COALESCE(u.uc, 0) / NULLIF(c.c, 0), 0.0) AS cpu_utilization,
       COALESCE(COALESCE(u.um, 0) / NULLIF(c.m, 0), 0.0) AS memory_utilization,
       COALESCE(COALESCE(u.ug, 0) / NULLIF(c.g, 0), 0.0) AS gpu_utilization,
       COALESCE(COALESCE(u.power, 0) / NULLIF(c.pw, 0), 0.0) AS power_utilization,
       COALESCE(u.power, 0.0) AS power_consumption, COALESCE(u.mk, 0.0) AS makespan_hours
  FROM {tag}_sub b LEFT JOIN {tag}_use u ON b.request_id = u.request_id LEFT JOIN {tag}_cap c ON b.request_id = c.request_id),
{tag}_summary AS (SELECT request_id, '{objective}' AS objective, n_jobs, n_placed, priority_efficiency, throughput_score,
       power_efficiency, {eff} AS efficiency_score, cpu_utilization, memory_utilization, gpu_utilization, power_utilization,
       power_consumption, makespan_hours,
       0.4 * {eff} + 0.3 * ((cpu_utilization + memory_utilization + gpu_utilization + power_utilization) / 4)
       + 0.3 * (1.0 / (power_consumption + 1)) AS balanced_score FROM {tag}_t)"""


SUMMARY_COLS = ["request_id", "objective", "n_jobs", "n_placed", "priority_efficiency", "throughput_score",
                "power_efficiency", "efficiency_score", "cpu_utilization", "memory_utilization", "gpu_utilization",
                "power_utilization", "power_consumption", "makespan_hours", "balanced_score"]


def summary_select(src: str) -> str:
    cols = []
    for c in SUMMARY_COLS:
        cols.append(f"{R(c)} AS {c}" if c not in ("request_id", "objective", "n_jobs", "n_placed") else c)
    return f"SELECT {', '.join(cols)} FROM {src}"


PLACEMENT_OUT = ["request_id", "job_id", "node_id", "queue_rank"]


def jobs_nodes(spark, sf):
    return X.jobs(spark, sf), X.nodes(spark, sf)


def _placement(spark, sf, objective):
    j, n = jobs_nodes(spark, sf)
    p, _ = A.place(j, n, objective)
    return p, j, n


# ---- single round: feasibility, scores, first choice -------------------------------

_FEAS_COND = " AND ".join(f"s.{c} >= p.{d}" for d, c, _, _ in SQL_DIMS)


@register("feasible_nodes", BASE_CTES + f"""
SELECT p.request_id, p.job_id, COUNT(*) AS n_feasible_nodes
FROM al_jobs p JOIN al_state s ON p.request_id = s.request_id AND {_FEAS_COND} GROUP BY p.request_id, p.job_id""",
          fixtures=FIX)
def q_feasible_nodes(spark, sf):
    j, n = jobs_nodes(spark, sf)
    return A.feasible_counts(j, n)


_FIRST_SQL = BASE_CTES + f"""
, f AS (SELECT p.*, s.node_id, s.node_ordinal, {NODE_SCORE_SQL} AS score, {BONUS_SQL} AS bonus
        FROM al_jobs p JOIN al_state s ON p.request_id = s.request_id AND {_FEAS_COND}),
b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY job_id ORDER BY score DESC, node_ordinal) AS rn FROM f)"""


@register("node_score", _FIRST_SQL + f"\nSELECT request_id, job_id, {R('score + bonus')} AS score FROM b WHERE rn = 1", fixtures=FIX)
def q_node_score(spark, sf):
    j, n = jobs_nodes(spark, sf)
    return round_doubles(A.first_choice(j, n, "efficiency").select("request_id", "job_id", "score"))


@register("best_node", _FIRST_SQL + "\nSELECT request_id, job_id, node_id FROM b WHERE rn = 1", fixtures=FIX)
def q_best_node(spark, sf):
    j, n = jobs_nodes(spark, sf)
    return A.first_choice(j, n, "efficiency").select("request_id", "job_id", "node_id")


def _order_query(objective):
    sql = BASE_CTES + f"""
SELECT request_id, job_id, ROW_NUMBER() OVER (PARTITION BY request_id ORDER BY {ORDER_SQL[objective]}) AS queue_rank FROM al_jobs"""

    def fn(spark, sf):
        j = A.allocation_jobs(X.jobs(spark, sf))
        ranked = running_totals(j, ["request_id"], A.queue_order(objective), rank_col="queue_rank")
        return ranked.select("request_id", "job_id", "queue_rank")
    register(f"order_{objective}", sql, fixtures=FIX)(fn)


for _o in A.OBJECTIVES:
    _order_query(_o)


_CUM_SQL = ", ".join(f"SUM({d}) OVER (PARTITION BY request_id, node_id ORDER BY {ORDER_SQL['efficiency']} "
                     f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_{d}" for d, _, _, _ in SQL_DIMS)


@register("node_admission", _FIRST_SQL + f""",
c AS (SELECT *, {_CUM_SQL} FROM b WHERE rn = 1)
SELECT c.request_id, c.job_id, c.node_id, {" AND ".join(f"c.cum_{d} <= s.{cap}" for d, cap, _, _ in SQL_DIMS)} AS admitted
FROM c JOIN al_state s ON c.request_id = s.request_id AND c.node_id = s.node_id""", fixtures=FIX)
def q_node_admission(spark, sf):
    j, n = jobs_nodes(spark, sf)
    chosen = A.first_choice(j, n, "efficiency")
    return admit(chosen, A.allocation_nodes(n), A.DIMS, A.queue_order("efficiency")).select("request_id", "job_id", "node_id", "admitted")


# ---- placements per objective ----------------------------------------------------------

def _place_query(objective):
    tag = f"pl_{objective[:3]}"
    sql = BASE_CTES + plan_sql(objective, tag) + f"\nSELECT {', '.join(PLACEMENT_OUT)} FROM {tag}_placements"

    def fn(spark, sf):
        p, _, _ = _placement(spark, sf, objective)
        return p.select(*PLACEMENT_OUT)
    register(f"place_{objective}", sql, fixtures=FIX)(fn)


for _o in A.OBJECTIVES:
    _place_query(_o)


@register("placement_maximality", BASE_CTES + "".join(plan_sql(o, f"pl_{o[:3]}") for o in A.OBJECTIVES) + ",\nlft AS (" + "\nUNION ALL ".join(
    f"SELECT *, '{o}' AS objective FROM ({still_fitting_sql('al_jobs', f'pl_{o[:3]}', SQL_DIMS)}) x" for o in A.OBJECTIVES) + """),
obj AS (SELECT UNNEST(['efficiency', 'throughput', 'power']) AS objective),
req AS (SELECT DISTINCT request_id FROM al_jobs)
SELECT r.request_id, o.objective, COUNT(l.job_id) AS n_still_fitting FROM req r CROSS JOIN obj o
LEFT JOIN lft l ON l.request_id = r.request_id AND l.objective = o.objective GROUP BY ALL""", fixtures=FIX)
def q_placement_maximality(spark, sf):
    """Unplaced jobs that still fit on a node of their request: none, for every request and objective."""
    return A.placement_maximality(*jobs_nodes(spark, sf))


def _eff_summary(spark, sf):
    p, j, n = _placement(spark, sf, "efficiency")
    return p, j, n, A.plan_summary(p, j, n, "efficiency")


_EFF = summary_sql("efficiency", "pe")


@register("node_usage", BASE_CTES + plan_sql("efficiency", "pe") + """
SELECT request_id, node_id, CAST(SUM(cpu_cores_required) AS BIGINT) AS used_cpu, SUM(memory_gb_required) AS used_memory,
       CAST(SUM(gpu_count_required) AS BIGINT) AS used_gpu, SUM(power_watts_estimated) AS used_power,
       SUM(network_bandwidth_gbps) AS used_bandwidth FROM pe_placements GROUP BY request_id, node_id""", fixtures=FIX)
def q_node_usage(spark, sf):
    p, _, _ = _placement(spark, sf, "efficiency")
    return A.node_usage(p)


def _summary_col_query(name, cols):
    sql = BASE_CTES + _EFF + "\nSELECT request_id, " + ", ".join(f"{R(c)} AS {c}" for c in cols) + " FROM pe_summary"

    def fn(spark, sf):
        *_, s = _eff_summary(spark, sf)
        return round_doubles(s.select("request_id", *cols))
    register(name, sql, fixtures=FIX)(fn)


_summary_col_query("resource_utilization", ["cpu_utilization", "memory_utilization", "gpu_utilization", "power_utilization"])
_summary_col_query("priority_efficiency", ["priority_efficiency"])
_summary_col_query("throughput_score", ["throughput_score"])
_summary_col_query("power_efficiency", ["power_efficiency"])
_summary_col_query("balanced_score", ["balanced_score"])
_summary_col_query("makespan", ["makespan_hours"])
_summary_col_query("power_total", ["power_consumption"])


@register("placement_details", BASE_CTES + plan_sql("efficiency", "pe") + """
SELECT p.request_id, p.job_id, p.node_id AS allocated_node_id, p.cpu_cores_required AS allocated_cpu_cores,
       p.memory_gb_required AS allocated_memory_gb, p.gpu_count_required AS allocated_gpu_count,
       n.node_efficiency_score AS allocation_efficiency
FROM pe_placements p JOIN nodes n ON p.request_id = n.request_id AND p.node_id = n.node_id""", fixtures=FIX)
def q_placement_details(spark, sf):
    p, _, n = _placement(spark, sf, "efficiency")
    return round_doubles(A.placement_details(p, n))


@register("allocation_times", BASE_CTES + plan_sql("efficiency", "pe") + f"""
SELECT request_id, job_id, node_id, TIMESTAMP '{ALLOC_START}' AS estimated_start_time,
       TIMESTAMP '{ALLOC_START}' + to_microseconds(CAST(ROUND(runtime_hours * 3600 * 1000000) AS BIGINT)) AS estimated_completion_time
FROM pe_placements""", fixtures=FIX)
def q_allocation_times(spark, sf):
    p, _, _ = _placement(spark, sf, "efficiency")
    return A.allocation_times(p, F.lit(ALLOC_START).cast("timestamp_ntz"))


@register("unplaced_jobs", BASE_CTES + plan_sql("efficiency", "pe") + """
SELECT request_id, job_id FROM al_jobs WHERE job_id NOT IN (SELECT job_id FROM pe_placements)""", fixtures=FIX)
def q_unplaced_jobs(spark, sf):
    p, j, _ = _placement(spark, sf, "efficiency")
    return A.unplaced_jobs(j, p)


_ALL_SUMMARIES = BASE_CTES + summary_sql("efficiency", "pe") + summary_sql("throughput", "pt") + \
    summary_sql("power", "pp") + """,
allsum AS (SELECT * FROM pe_summary UNION ALL SELECT * FROM pt_summary UNION ALL SELECT * FROM pp_summary),
pick AS (SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY request_id ORDER BY balanced_score DESC,
         CASE objective WHEN 'efficiency' THEN 1 WHEN 'throughput' THEN 2 ELSE 3 END) AS rn FROM allsum) q WHERE rn = 1)"""


@register("pick_objective", _ALL_SUMMARIES + "\n" + summary_select("pick"), fixtures=FIX)
def q_pick_objective(spark, sf):
    j, n = jobs_nodes(spark, sf)
    _, _, choice = A.place_balanced(j, n)
    return round_doubles(choice.select(*SUMMARY_COLS))


@register("place_balanced", _ALL_SUMMARIES + """,
allp AS (SELECT *, 'efficiency' AS objective FROM pe_placements UNION ALL SELECT *, 'throughput' FROM pt_placements
         UNION ALL SELECT *, 'power' FROM pp_placements)
SELECT a.request_id, a.job_id, a.node_id, a.queue_rank, a.objective FROM allp a JOIN pick k
  ON a.request_id = k.request_id AND a.objective = k.objective""", fixtures=FIX)
def q_place_balanced(spark, sf):
    j, n = jobs_nodes(spark, sf)
    chosen, _, _ = A.place_balanced(j, n)
    return chosen.select(*PLACEMENT_OUT, "objective")


_ADVICE_SQL = BASE_CTES + _EFF + f"""
SELECT request_id, objective, list_filter([
  CASE WHEN (cpu_utilization + memory_utilization + gpu_utilization + power_utilization) / 4 < {A.LOW_UTIL} THEN '{A.MSG_LOW_UTIL}'
       WHEN (cpu_utilization + memory_utilization + gpu_utilization + power_utilization) / 4 > {A.HIGH_UTIL} THEN '{A.MSG_HIGH_UTIL}' END,
  CASE WHEN efficiency_score < {A.LOW_EFFICIENCY} THEN '{A.MSG_LOW_EFF}' END,
  CASE WHEN power_consumption > {A.HIGH_POWER} THEN '{A.MSG_HIGH_POWER}' END,
  CASE WHEN n_jobs - n_placed > 0 THEN CAST(n_jobs - n_placed AS VARCHAR) || '{A.MSG_UNPLACED}' END], lambda x: x IS NOT NULL)
  AS recommendations FROM pe_summary"""


@register("advice", _ADVICE_SQL, fixtures=FIX)
def q_advice(spark, sf):
    *_, s = _eff_summary(spark, sf)
    return A.advice(s)


@register("objective_registry", _ALL_SUMMARIES + """,
allp AS (SELECT *, 'efficiency' AS objective FROM pe_placements UNION ALL SELECT *, 'throughput' FROM pt_placements
         UNION ALL SELECT *, 'power' FROM pp_placements)
SELECT 'power' AS asked, request_id, job_id, node_id, objective FROM allp WHERE objective = 'power'
UNION ALL SELECT 'no-such-objective', a.request_id, a.job_id, a.node_id, a.objective FROM allp a JOIN pick k
  ON a.request_id = k.request_id AND a.objective = k.objective""", fixtures=FIX)
def q_objective_registry(spark, sf):
    """Dispatch by name: a known objective, and an unknown one that gets the balanced default."""
    j, n = jobs_nodes(spark, sf)
    out = [A.optimize(j, n, name).select(F.lit(name).alias("asked"), "request_id", "job_id", "node_id", "objective")
           for name in ("power", "no-such-objective")]
    return out[0].unionByName(out[1])
