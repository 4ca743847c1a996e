"""SQL twins of the placement and of the user quotas, for the DuckDB oracle.

``placement_ctes`` is the one-job-at-a-time loop as a recursive CTE: a step takes the next job of every request's
queue, scores the request's nodes (lists in ordinal order) and adds the job to the first of the best.
``quota_ctes`` does the same for the quotas alone: admit if the user's charged amounts and the job stay
within the quota, else skip and go on.
"""

from __future__ import annotations

import re

USER_LIMITS = [("max_cpu_cores", "cpu_cores_required", "BIGINT"), ("max_memory_gb", "memory_gb_required", "DOUBLE"), ("max_concurrent_jobs", "1", "BIGINT")]


def placement_ctes(jobs_cte: str, state_cte: str, dims, order_sql: str, score_sql: str, extra_sql: str | None = None,
                   tag: str = "pl", node_cols: tuple[str, ...] = (), quotas: bool = False) -> str:
    """CTE text (starting with ', ') that defines ``{tag}_placements`` and ``{tag}_state``.

    ``dims`` = [(demand, capacity, used, sql_type_of_used)]; ``jobs_cte`` rows carry request_id, job_id and the demand
    columns; ``state_cte`` rows carry request_id, node_id, node_ordinal, capacities and ``node_cols``.
    ``extra_sql`` says which nodes are open.  ``quotas``: a job must fit its user's limits too.
    """
    used = [(u, d, t) for d, _, u, t in dims] + [("n_placed", "1", "BIGINT")]
    charged = [(f"u_{i}", q, d, t) for i, (q, d, t) in enumerate(USER_LIMITS)] if quotas else []
    fixed = [c for _, c, _, _ in dims] + list(node_cols)
    score = re.sub(r"\b(" + "|".join(fixed) + r")\b", r"n.\1[i]", score_sql)
    score = re.sub(r"\b(" + "|".join(u for u, _, _ in used) + r")\b", r"p.\1[i]", score)
    score = re.sub(r"(?<![.\w])(" + "|".join(d for d, _, _, _ in dims) + r"|priority)\b", r"q.\1", score)
    fits = " AND ".join(f"n.{c}[i] - p.{u}[i] >= q.{d}" for d, c, u, _ in dims)
    allowed = "".join(f" AND (q.{q} IS NULL OR p.{u}[q.user_ix] + {d if d == '1' else 'q.' + d} <= q.{q})" for u, q, d, _ in charged)
    zeros = ", ".join([f"list_transform(range(n), lambda x: CAST(0 AS {t})) AS {u}" for u, _, t in used]
                      + [f"list_transform(range(n_users), lambda x: CAST(0 AS {t})) AS {u}" for u, _, _, t in charged])
    grown = ", ".join([f"CASE WHEN best IS NULL THEN {u} ELSE list_transform({u}, lambda x, i: CAST(CASE WHEN i = best THEN x + {d} ELSE x END AS {t})) END"
                       for u, d, t in used]
                      + [f"CASE WHEN best IS NULL THEN {u} ELSE list_transform({u}, lambda x, i: CAST(CASE WHEN i = user_ix THEN x + {d} ELSE x END AS {t})) END"
                         for u, _, d, t in charged])
    lists = ", ".join(f"LIST({c} ORDER BY node_ordinal) AS {c}" for c in ["node_id", "node_ordinal", *fixed])
    state = ", ".join([*[f"UNNEST(n.{c}) AS {c}" for c in ["node_id", "node_ordinal", *fixed]], *[f"UNNEST(p.{u}) AS {u}" for u, _, _ in used]])
    step = ", ".join(["queue_rank", "best", "score", *[u for u, _, _ in used], *[u for u, *_ in charged]])
    kept = ", ".join(f"p.{u}" for u in [*[u for u, _, _ in used], *[u for u, *_ in charged]])
    users = ", DENSE_RANK() OVER (PARTITION BY request_id ORDER BY user_id) AS user_ix" if quotas else ""
    n_users = f"(SELECT COALESCE(MAX(user_ix), 0) FROM {tag}_q q WHERE q.request_id = n.request_id) AS n_users" if quotas else "0 AS n_users"
    return f""",
{tag}_q AS MATERIALIZED (SELECT *, ROW_NUMBER() OVER (PARTITION BY request_id ORDER BY {order_sql}) AS queue_rank{users} FROM {jobs_cte}),
{tag}_n AS MATERIALIZED (SELECT request_id, COUNT(*) AS n, {lists} FROM {state_cte} s WHERE {extra_sql or 'TRUE'} GROUP BY request_id),
{tag}_step(request_id, {step}) AS (
  SELECT request_id, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), {zeros} FROM (SELECT n.*, {n_users} FROM {tag}_n n) m
  UNION ALL
  SELECT request_id, queue_rank, best, CASE WHEN best IS NULL THEN NULL ELSE scores[best] END, {grown}
  FROM (SELECT *, CASE WHEN list_max(scores) IS NULL THEN NULL ELSE CAST(list_position(scores, list_max(scores)) AS BIGINT) END AS best
    FROM (SELECT q.*, {kept}, list_transform(range(1, n.n + 1), lambda i: CASE WHEN {fits}{allowed} THEN {score} END) AS scores
      FROM {tag}_step p JOIN {tag}_q q ON q.request_id = p.request_id AND q.queue_rank = p.queue_rank + 1
      JOIN {tag}_n n ON n.request_id = p.request_id) a) b),
{tag}_placements AS MATERIALIZED (SELECT q.*, n.node_id[p.best] AS node_id, p.score FROM {tag}_step p
  JOIN {tag}_q q ON q.request_id = p.request_id AND q.queue_rank = p.queue_rank
  JOIN {tag}_n n ON n.request_id = p.request_id WHERE p.best IS NOT NULL),
{tag}_state AS MATERIALIZED (SELECT p.request_id, {state} FROM (SELECT * FROM {tag}_step
    QUALIFY ROW_NUMBER() OVER (PARTITION BY request_id ORDER BY queue_rank DESC) = 1) p JOIN {tag}_n n ON n.request_id = p.request_id)"""


def still_fitting_sql(jobs_cte: str, tag: str, dims, extra_sql: str | None = None) -> str:
    """Jobs not in ``{tag}_placements`` that fit on a node in ``{tag}_state``."""
    cond = " AND ".join([f"s.{c} - s.{u} >= j.{d}" for d, c, u, _ in dims] + ([extra_sql] if extra_sql else []))
    return f"""SELECT j.request_id, j.job_id FROM {jobs_cte} j WHERE j.job_id NOT IN (SELECT job_id FROM {tag}_placements)
  AND EXISTS (SELECT 1 FROM {tag}_state s WHERE s.request_id = j.request_id AND {cond})"""


def quota_ctes(jobs_cte: str, order_sql: str, tag: str, charged_cte: str | None = None) -> str:
    """CTE text defining ``{tag}_fair``: the jobs of ``jobs_cte`` that the users' quotas admit one after the other."""
    free = "max_cpu_cores IS NULL AND max_memory_gb IS NULL AND max_concurrent_jobs IS NULL"
    charged = f"LEFT JOIN {charged_cte} c ON j.request_id = c.request_id AND j.user_id = c.user_id" if charged_cte else ""
    have = {c: f"COALESCE(c.{c}, 0)" if charged_cte else "0" for c in ("cpu", "memory", "jobs")}

    def ok(cpu, memory, jobs):
        return (f"((q.max_cpu_cores IS NULL OR {cpu} + q.cpu_cores_required <= q.max_cpu_cores) AND (q.max_memory_gb IS NULL OR "
                f"{memory} + q.memory_gb_required <= q.max_memory_gb) AND (q.max_concurrent_jobs IS NULL OR {jobs} + 1 <= q.max_concurrent_jobs))")

    def row(cpu, memory, jobs):
        y = ok(cpu, memory, jobs)
        return (f"q.request_id, q.user_id, q.job_id, q.rn, CAST({cpu} + CASE WHEN {y} THEN q.cpu_cores_required ELSE 0 END AS BIGINT), "
                f"CAST({memory} + CASE WHEN {y} THEN q.memory_gb_required ELSE 0 END AS DOUBLE), "
                f"CAST({jobs} + CASE WHEN {y} THEN 1 ELSE 0 END AS BIGINT), {y}")
    return f""",
{tag}_q AS MATERIALIZED (SELECT j.*, {have['cpu']} AS cpu0, {have['memory']} AS memory0, {have['jobs']} AS jobs0,
  ROW_NUMBER() OVER (PARTITION BY j.request_id, j.user_id ORDER BY {order_sql}) AS rn FROM {jobs_cte} j {charged} WHERE NOT ({free})),
{tag}_step(request_id, user_id, job_id, rn, cpu, memory, jobs, ok) AS (
  SELECT {row('q.cpu0', 'q.memory0', 'q.jobs0')} FROM {tag}_q q WHERE q.rn = 1
  UNION ALL
  SELECT {row('p.cpu', 'p.memory', 'p.jobs')} FROM {tag}_step p
  JOIN {tag}_q q ON q.request_id = p.request_id AND q.user_id = p.user_id AND q.rn = p.rn + 1),
{tag}_fair AS MATERIALIZED (SELECT * FROM {jobs_cte} WHERE {free}
  UNION ALL SELECT j.* FROM {jobs_cte} j WHERE j.job_id IN (SELECT job_id FROM {tag}_step WHERE ok))"""
