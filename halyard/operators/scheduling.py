"""Job scheduling: queue policies, user quotas, placement, node timelines, metrics."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from halyard.functions.scalar import priority_class
from halyard.operators.dominance import best_nodes
from halyard.operators.placement import Dim, Likeness, Quota, demand_vectors, init_state, place_jobs, sorted_pair, vector_key
from halyard.operators.prefix import running_max_plus, running_totals
from halyard.session import cut_lineage

DIMS = [
    Dim("cpu_cores_required", "available_cpu_cores", "used_cpu"),
    Dim("memory_gb_required", "available_memory_gb", "used_memory"),
    Dim("gpu_count_required", "available_gpu_count", "used_gpu"),
]
JOB_COLS = ["request_id", "job_id", "job_ordinal", "user_id", "priority", "estimated_runtime_minutes",
            "cpu_cores_required", "memory_gb_required", "gpu_count_required", "submission_time",
            "earliest_start_time"]

# Fixed values that must equal the reference's.
# Score: .6 * balance + .4 * availability (1 while the node has no job yet, else .5).
W_BALANCE, W_AVAIL = 0.6, 0.4
AVAIL_FREE, AVAIL_BUSY = 1.0, 0.5
HIGH_PRIORITY = 7
DEFAULT_USER_PRIORITY = 1
POLICIES = ["fifo", "sjf", "priority", "fair_share", "backfill"]
DEFAULT_POLICY = "fair_share"
POLICY_DESCRIPTIONS = {
    "fifo": "jobs in the order they were submitted",
    "sjf": "jobs with the least estimated runtime first",
    "priority": "jobs of higher priority first, older ones first among equals",
    "fair_share": "users with few jobs and high priority first, within their quotas",
    "backfill": "high priorities first, then short jobs",
}


def scheduler_jobs(jobs: DataFrame) -> DataFrame:
    j = jobs if "earliest_start_time" in jobs.columns else \
        jobs.withColumn("earliest_start_time", F.lit(None).cast("timestamp_ntz"))
    return j.select(*JOB_COLS)


def scheduler_nodes(nodes: DataFrame) -> DataFrame:
    return init_state(nodes, DIMS, extra_cols=["is_available", "total_cpu_cores", "total_memory_gb", "total_gpu_count"])


def user_job_counts(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("request_id", "user_id").agg(F.count(F.lit(1)).alias("user_job_count"))


def quota_lookup(jobs: DataFrame, quotas: DataFrame) -> DataFrame:
    """Per job: user priority (default 1) and limits (NULL = unlimited)."""
    q = quotas.select("user_id", "user_priority", "max_cpu_cores", "max_memory_gb", "max_concurrent_jobs")
    return jobs.join(q, "user_id", "left").withColumn(
        "user_priority", F.coalesce(F.col("user_priority"), F.lit(DEFAULT_USER_PRIORITY)))


def with_fair_key(jobs: DataFrame, quotas: DataFrame) -> DataFrame:
    """fair_key = -(priority * user_priority) / jobs of the user in the request."""
    j = quota_lookup(jobs, quotas).join(user_job_counts(jobs), ["request_id", "user_id"])
    return j.withColumn("fair_key", (-F.col("priority") * F.col("user_priority")) / F.col("user_job_count"))


def sort_keys(policy: str) -> list[Column]:
    """The documented order of a policy as ascending keys; equal keys keep input (ordinal) order."""
    if policy == "fifo":
        keys = [F.col("submission_time")]
    elif policy == "sjf":
        keys = [F.col("estimated_runtime_minutes")]
    elif policy == "priority":
        keys = [-F.col("priority"), F.col("submission_time")]
    elif policy == "backfill":
        hi = F.col("priority") >= HIGH_PRIORITY
        keys = [F.when(hi, 0).otherwise(1), F.when(hi, -F.col("priority")).otherwise(F.col("estimated_runtime_minutes"))]
    elif policy == "fair_share":
        keys = [F.col("fair_key"), F.col("submission_time")]
    else:
        raise ValueError(policy)
    return [*keys, F.col("job_ordinal")]


def queue_order(policy: str) -> list[Column]:
    return [k.asc() for k in sort_keys(policy)]


def priority_split(jobs: DataFrame) -> DataFrame:
    return jobs.select("request_id", "job_id", "priority", priority_class(F.col("priority")).alias("priority_class"))


# Quota column, demand and the name of the user's charged amount; a job counts one.
QUOTAS = [("max_cpu_cores", "cpu_cores_required", "_cpu"), ("max_memory_gb", "memory_gb_required", "_memory"),
          ("max_concurrent_jobs", "1", "_jobs")]
USER = ["request_id", "user_id"]
PLACED_QUOTAS = tuple(Quota(q, None if d == "1" else d, c) for q, d, c in QUOTAS)


ADMIT_BLOCK, FIRST_ADMITTED, MOST_ADMITTED = 256, 1024, 65_536  # ranks counted together, jobs of a user that a task decides


def quota_admission(jobs_fair: DataFrame) -> DataFrame:
    """Jobs that their user's quota admits one after the other (fair order), skipping those that do not fit.

    Users without a quota row are unlimited.  Jobs that do not fit alone on top of what their user holds never will and
    are dropped everywhere at once; of the others each user's next ones in order, about 1,024 at first, twice as many
    every time, are decided one after the other by one task, which holds three numbers.  The prefix comes from counts per
    block of ranks, so a user with very many jobs is never read by one task as a whole.
    """
    unlimited = F.lit(True)
    for q, _, _ in QUOTAS:
        unlimited = unlimited & F.col(q).isNull()
    queue = running_totals(jobs_fair.where(~unlimited), USER, queue_order("fair_share"), rank_col="_rank")
    queue = cut_lineage(queue, "quota")
    held = {c: "double" if d == "memory_gb_required" else "long" for _, d, c in QUOTAS}
    fields = ["request_id", "user_id"]
    schema = T.StructType([T.StructField("kind", T.StringType()), *[queue.schema[c] for c in fields], T.StructField("_rank", T.LongType()),
                           *[T.StructField(c, T.DoubleType() if t == "double" else T.LongType()) for c, t in held.items()],
                           T.StructField("_beyond", T.LongType())])
    arrow, names = to_arrow_schema(schema), list(held)

    def decide(chunk: pa.Table) -> pa.Table:
        rows = chunk.sort_by("_rank").to_pylist()
        now, admitted = [rows[0][c] for c in names], []
        for r in rows:
            after = [h + (1 if d == "1" else r[d]) for (_, d, _), h in zip(QUOTAS, now)]
            if all(r[q] is None or a <= r[q] for (q, _, _), a in zip(QUOTAS, after)):
                now = after
                admitted.append(r["_rank"])
        key = {c: rows[0][c] for c in fields}
        out = [{"kind": "job", **key, "_rank": rank} for rank in admitted]
        return pa.Table.from_pylist([*out, {"kind": "user", **key, "_rank": rows[0]["_until"], "_beyond": rows[0]["_beyond"], **dict(zip(names, now))}], arrow)
    rounds, size, users = [], FIRST_ADMITTED, None
    while True:
        waiting = queue if users is None else queue.join(users, USER, "left") \
            .where(F.col("_done").isNull() | (F.col("_rank") > F.col("_done")))
        for q, d, c in QUOTAS:
            have = F.lit(0) if users is None else F.coalesce(F.col(c), F.lit(0))
            waiting = waiting.withColumn(c, have.cast(held[c])).where(F.col(q).isNull() | (F.col(c) + F.expr(d) <= F.col(q)))
        blocks = waiting.groupBy(*USER, F.floor((F.col("_rank") - 1) / ADMIT_BLOCK).alias("_block")).agg(F.count(F.lit(1)).alias("_n"))
        before = Window.partitionBy(*USER).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        prefix = blocks.withColumn("_in", F.coalesce(F.sum("_n").over(before), F.lit(0)) < size).groupBy(*USER) \
            .agg(((F.max(F.when(F.col("_in"), F.col("_block"))) + 1) * ADMIT_BLOCK).cast("long").alias("_until"),
                 F.coalesce(F.sum(F.when(~F.col("_in"), F.col("_n"))), F.lit(0)).alias("_beyond"))
        needed = [*USER, "_rank", *[q for q, _, _ in QUOTAS], *[d for _, d, _ in QUOTAS if d != "1"], *names, "_until", "_beyond"]
        chunk = waiting.join(prefix, USER).where("_rank <= _until").select(*needed)
        decided = cut_lineage(chunk.groupBy(*USER).applyInArrow(decide, schema), "admitted")
        rounds.append(decided)
        latest = [d.where("kind = 'user'").select(*USER, F.lit(i).alias("_i"), F.col("_rank").alias("_done"), *names) for i, d in enumerate(rounds)]
        every = latest[0]
        for part in latest[1:]:
            every = every.unionByName(part)
        users = every.groupBy(*USER).agg(F.max(F.struct("_i", "_done", *names)).alias("_u")).select(*USER, "_u._done", *[f"_u.{c}" for c in names])
        if decided.agg(F.coalesce(F.sum("_beyond"), F.lit(0))).first()[0] == 0:
            break
        size = min(2 * size, MOST_ADMITTED)
    won = rounds[0].where("kind = 'job'").select(*USER, "_rank")
    for decided in rounds[1:]:
        won = won.unionByName(decided.where("kind = 'job'").select(*USER, "_rank"))
    admitted = queue.join(won, [*USER, "_rank"], "left_semi").select(*jobs_fair.columns)
    return jobs_fair.where(unlimited).unionByName(admitted)


def node_scores(job: dict, node: dict) -> np.ndarray:
    """.6 * balance of what is left + .4 * availability, over arrays."""
    with np.errstate(divide="ignore", invalid="ignore"):
        cu = job["cpu_cores_required"] / (node["available_cpu_cores"] - node["used_cpu"])
        mu = job["memory_gb_required"] / (node["available_memory_gb"] - node["used_memory"])
        score = (1.0 - np.abs(cu - mu)) * W_BALANCE + np.where(node["n_placed"] == 0, AVAIL_FREE, AVAIL_BUSY) * W_AVAIL
    return np.where(np.isfinite(score), score, 0.0)  # nothing left of what the job does not need


INDEX_BY = ["n_placed", "cpu_per_gb"]


def with_ratio(state: DataFrame) -> DataFrame:
    """Node state with the ratio of what is left of cpu and memory, which decides how even a job's shares are."""
    left = [F.col(c) - F.col(u) for c, u in (("available_cpu_cores", "used_cpu"), ("available_memory_gb", "used_memory"))]
    return state.withColumn("cpu_per_gb", F.coalesce(F.try_divide(left[0].cast("double"), left[1].cast("double")), F.lit(float("inf"))))


def node_bound(job: dict, low: dict, high: dict) -> np.ndarray:
    """What ``node_scores`` can be at most between the nodes ``low`` and ``high``.

    The shares of cpu and memory differ by |cpu - memory * ratio| / cpu left.
    """
    cpu, memory = job["cpu_cores_required"], job["memory_gb_required"]
    with np.errstate(divide="ignore", invalid="ignore"):
        off = np.fmax(np.fmax(memory * low["cpu_per_gb"] - cpu, cpu - memory * high["cpu_per_gb"]), 0.0)
        apart = off / (high["available_cpu_cores"] - low["used_cpu"])
    apart = np.where(np.isfinite(apart), apart, 0.0)
    return (1.0 - apart) * W_BALANCE + np.where(low["n_placed"] == 0, AVAIL_FREE, AVAIL_BUSY) * W_AVAIL


def left_parts(node: dict) -> dict:
    """Whether a node is without a job, what it has left of cpu to memory, its cores left, and the shares that a core and a GB are of that."""
    cpu, memory = node["available_cpu_cores"] - node["used_cpu"], node["available_memory_gb"] - node["used_memory"]
    with np.errstate(divide="ignore", invalid="ignore"):
        return {"free": node["n_placed"] == 0, "cpu_per_gb": cpu / memory, "cores": cpu, "core": 1.0 / cpu, "gb": 1.0 / memory}


def left_bound(job: dict, low: dict, high: dict) -> np.ndarray:
    """What ``node_scores`` can be at most between the parts ``low`` and ``high``; a score that is no number counts 0."""
    cpu, memory = job["cpu_cores_required"], job["memory_gb_required"]
    core, gb = sorted_pair(cpu * low["core"], cpu * high["core"]), sorted_pair(memory * low["gb"], memory * high["gb"])
    apart = np.maximum(np.maximum(core[0] - gb[1], gb[0] - core[1]), 0.0)
    off = np.maximum(np.maximum(memory * low["cpu_per_gb"] - cpu, cpu - memory * high["cpu_per_gb"]), 0.0)
    apart = np.fmax(apart, np.where((low["cores"] > 0) & (memory >= 0), off / high["cores"], 0.0))
    bound = (1.0 - apart) * W_BALANCE + np.where(high["free"] > 0, AVAIL_FREE, AVAIL_BUSY) * W_AVAIL
    return np.where((low["cores"] > 0) & np.isfinite(high["gb"]), bound, np.maximum(bound, 0.0))


LIKE = Likeness(left_parts, left_bound)


def available_expr() -> Column:
    return F.col("is_available")


def now_of(jobs: DataFrame) -> DataFrame:
    """The scheduling instant: the latest submission (one row, broadcast-bounded)."""
    return jobs.agg(F.max("submission_time").alias("_now"))


def first_choice(jobs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Every job with its best node and score at empty usage."""
    j = scheduler_jobs(jobs)
    best = best_nodes(demand_vectors(j, DIMS), with_ratio(scheduler_nodes(nodes)), DIMS, node_scores, node_bound, INDEX_BY, available_expr())
    return j.join(best, vector_key(DIMS))


def node_timeline(placed: DataFrame, now: DataFrame) -> DataFrame:
    """start = max(now, earliest start, end of the previous job on the node); max-plus scan.

    end_i = S_i + max_{j<=i}(r_j - S_{j-1}) with S the running runtime and r
    the release time, computed with the skew-safe ``running_max_plus`` so a
    node holding very many jobs is still spread over many tasks.
    """
    now_us = F.unix_micros(F.col("_now").cast("timestamp"))
    rel = F.greatest(now_us, F.coalesce(F.unix_micros(F.col("earliest_start_time").cast("timestamp")), now_us))
    t = (placed.crossJoin(F.broadcast(now))
         .withColumn("_d", F.col("estimated_runtime_minutes").cast("bigint") * 60_000_000)
         .withColumn("_rel", rel))
    scanned = running_max_plus(t, ["request_id", "node_id"], [F.col("queue_rank").asc()], "_d", "_rel")
    ts = lambda us: F.timestamp_micros(us).cast("timestamp_ntz")
    return scanned.select(
        *placed.columns,
        ts(F.col("_end") - F.col("_d")).alias("scheduled_start_time"), ts(F.col("_end")).alias("estimated_completion_time"),
        (F.col("_rank") - 1).cast("int").alias("queue_position"))


def schedule(jobs: DataFrame, nodes: DataFrame, quotas: DataFrame, policy: str):
    """Schedule one batch table under ``policy``; unknown names use fair share.

    Returns (scheduled rows, jobs table used, node state).
    """
    if policy not in POLICIES:
        policy = DEFAULT_POLICY
    j = with_fair_key(scheduler_jobs(jobs), quotas)
    limits = PLACED_QUOTAS if policy == "fair_share" else ()  # a job is charged to its user when it gets a node
    placed, state = place_jobs(j, scheduler_nodes(nodes), DIMS, queue_order(policy), node_scores, LIKE, extra=available_expr, quotas=limits)
    timeline = node_timeline(placed, now_of(jobs))
    out = timeline.select(
        "request_id", "job_id", "node_id", "scheduled_start_time", "estimated_completion_time",
        F.col("cpu_cores_required").alias("allocated_cpu_cores"),
        F.col("memory_gb_required").alias("allocated_memory_gb"),
        F.col("gpu_count_required").alias("allocated_gpu_count"), "queue_position")
    return out, j, state


def schedule_with_submission(scheduled: DataFrame, jobs: DataFrame) -> DataFrame:
    j = jobs.select("request_id", "job_id", "submission_time")
    wait = (F.unix_micros(F.col("scheduled_start_time").cast("timestamp"))
            - F.unix_micros(F.col("submission_time").cast("timestamp"))) / 60_000_000.0
    return scheduled.join(j, ["request_id", "job_id"]).withColumn("wait_minutes", F.greatest(F.lit(0.0), wait))


def schedule_summary(scheduled: DataFrame, jobs: DataFrame, nodes: DataFrame, policy: str) -> DataFrame:
    """Counts, efficiency, cluster utilisation and average wait per request."""
    tot = jobs.groupBy("request_id").agg(F.count(F.lit(1)).alias("total_jobs"))
    cap = nodes.groupBy("request_id").agg(F.sum("total_cpu_cores").alias("_c"), F.sum("total_memory_gb").alias("_m"),
                                          F.sum("total_gpu_count").alias("_g"))
    sw = schedule_with_submission(scheduled, jobs)
    s = sw.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("scheduled_count"), F.sum("allocated_cpu_cores").alias("_uc"),
        F.sum("allocated_memory_gb").alias("_um"), F.sum("allocated_gpu_count").alias("_ug"),
        F.avg("wait_minutes").alias("_wait"))
    t = tot.join(s, "request_id", "left").join(cap, "request_id", "left")
    n = F.coalesce(F.col("scheduled_count"), F.lit(0))
    util = lambda u, c: F.coalesce(F.try_divide(F.coalesce(F.col(u), F.lit(0)), F.col(c)), F.lit(0.0))
    return t.select(
        "request_id", F.lit(policy).alias("policy_used"), "total_jobs", n.alias("scheduled_count"),
        F.coalesce(F.try_divide(n, F.col("total_jobs")), F.lit(0.0)).alias("scheduling_efficiency"),
        util("_uc", "_c").alias("cpu_utilization"), util("_um", "_m").alias("memory_utilization"),
        util("_ug", "_g").alias("gpu_utilization"),
        F.coalesce(F.col("_wait"), F.lit(0.0)).alias("average_wait_time_minutes"))


def unscheduled_jobs(jobs: DataFrame, scheduled: DataFrame) -> DataFrame:
    return jobs.select("request_id", "job_id").join(scheduled.select("request_id", "job_id"),
                                                    ["request_id", "job_id"], "left_anti")


def missing_dependencies(jobs: DataFrame, deps: DataFrame) -> DataFrame:
    """Dependency ids (edge rows job_id, dependency_id) that are not jobs of the same request."""
    j = jobs.select("request_id", "job_id")
    edges = deps.join(j, "job_id").select("request_id", "job_id", "dependency_id")
    known = j.select("request_id", F.col("job_id").alias("dependency_id"))
    return edges.join(known, ["request_id", "dependency_id"], "left_anti")


def policy_listing(spark, jobs: DataFrame, quotas: DataFrame) -> DataFrame:
    """The registered policies (name, description, default) with the job that each puts first per request."""
    j = with_fair_key(scheduler_jobs(jobs), quotas)
    out = None
    for p in POLICIES:
        # descending keys are numbers in all policies: the smallest of the negated key is the first
        rows = j.groupBy("request_id").agg(F.min_by("job_id", F.struct(*[k.alias(f"k{i}") for i, k in enumerate(sort_keys(p))])).alias("first_job")).select(
            F.lit(p).alias("policy"), F.lit(POLICY_DESCRIPTIONS[p]).alias("description"),
            F.lit(p == DEFAULT_POLICY).alias("is_default"), "request_id", "first_job")
        out = rows if out is None else out.unionByName(rows)
    return out
