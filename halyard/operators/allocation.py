"""Resource allocation: jobs x nodes under four objectives, with utilisation metrics and advice."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from halyard.functions.scalar import add_hours
from halyard.operators.dominance import best_nodes, node_counts
from halyard.operators.placement import Dim, Likeness, demand_vectors, init_state, place_jobs, sorted_pair, still_fitting, vector_key
from halyard.session import cut_lineage

DIMS = [
    Dim("cpu_cores_required", "available_cpu_cores", "used_cpu"),
    Dim("memory_gb_required", "available_memory_gb", "used_memory"),
    Dim("gpu_count_required", "available_gpu_count", "used_gpu"),
    Dim("power_watts_estimated", "available_power_watts", "used_power"),
    Dim("network_bandwidth_gbps", "available_network_bandwidth_gbps", "used_bandwidth"),
]
JOB_COLS = ["request_id", "job_id", "job_ordinal", "priority", "runtime_hours", "cpu_cores_required",
            "memory_gb_required", "gpu_count_required", "power_watts_estimated", "network_bandwidth_gbps"]

# Fixed values that must equal the reference's.
# Score weights: balance .4, node efficiency .4, priority/10 .2.
W_BALANCE, W_NODE_EFF, W_PRIORITY = 0.4, 0.4, 0.2
# Balanced objective: .4 * efficiency score + .3 * mean utilisation + .3 / (power + 1).
W_OBJ_EFF, W_OBJ_UTIL, W_OBJ_POWER = 0.4, 0.3, 0.3
# Advice thresholds and messages.
LOW_UTIL, HIGH_UTIL, LOW_EFFICIENCY, HIGH_POWER = 0.6, 0.9, 0.7, 50000
MSG_LOW_UTIL = "Consider consolidating workloads to fewer nodes for better efficiency"
MSG_HIGH_UTIL = "Cluster utilization is very high - consider scaling out"
MSG_LOW_EFF = "Low allocation efficiency - review job priorities and resource requirements"
MSG_HIGH_POWER = "High power consumption detected - consider power-optimized scheduling"
MSG_UNPLACED = " jobs could not be allocated - insufficient resources"
# Objective names in tie-break order of the balanced choice; unknown names mean "balanced".
OBJECTIVES = ["efficiency", "throughput", "power"]
DEFAULT_OBJECTIVE = "balanced"


def allocation_jobs(jobs: DataFrame) -> DataFrame:
    """Scheduler-style job rows -> allocation rows (runtime in hours)."""
    j = jobs if "runtime_hours" in jobs.columns else \
        jobs.withColumn("runtime_hours", F.col("estimated_runtime_minutes") / 60.0)
    return j.select(*JOB_COLS)


def allocation_nodes(nodes: DataFrame) -> DataFrame:
    return init_state(nodes, DIMS, extra_cols=["node_efficiency_score"])


def queue_order(objective: str) -> list[Column]:
    """Queue order per objective; equal keys keep input (ordinal) order."""
    if objective == "efficiency":
        keys = [F.col("priority").desc(), F.col("runtime_hours").asc()]
    elif objective == "throughput":
        keys = [(F.col("cpu_cores_required") + F.col("memory_gb_required")).asc()]
    elif objective == "power":
        keys = [F.col("power_watts_estimated").asc()]
    else:
        raise ValueError(objective)
    return keys + [F.col("job_ordinal").asc()]


def priority_bonus() -> Column:
    """.2 * priority / 10: the job's part of the score, the same on every node."""
    return (F.col("priority") / 10.0) * W_PRIORITY


def demand_scores(job: dict, node: dict) -> np.ndarray:
    """.4 * (1 - |cpu_util - mem_util|) + .4 * node efficiency, utils after placing, over arrays (without the job's part)."""
    cu = (job["cpu_cores_required"] + node["used_cpu"]) / node["available_cpu_cores"]
    mu = (job["memory_gb_required"] + node["used_memory"]) / node["available_memory_gb"]
    return (1.0 - np.abs(cu - mu)) * W_BALANCE + node["node_efficiency_score"] * W_NODE_EFF


def demand_bound(job: dict, low: dict, high: dict) -> np.ndarray:
    """What ``demand_scores`` can be at most between the nodes ``low`` and ``high``."""
    with np.errstate(divide="ignore", invalid="ignore"):
        cpu = [(job["cpu_cores_required"] + a["used_cpu"]) / b["available_cpu_cores"] for a, b in ((low, high), (high, low))]
        memory = [(job["memory_gb_required"] + a["used_memory"]) / b["available_memory_gb"] for a, b in ((low, high), (high, low))]
    apart = np.fmax(np.fmax(cpu[0] - memory[1], memory[0] - cpu[1]), 0.0)
    return (1.0 - apart) * W_BALANCE + high["node_efficiency_score"] * W_NODE_EFF


def node_scores(job: dict, node: dict) -> np.ndarray:
    return demand_scores(job, node) + (job["priority"] / 10.0) * W_PRIORITY


def demand_parts(node: dict) -> dict:
    """How much more of its cpu than of its memory a node uses, the shares that a core and a GB are, and its efficiency."""
    with np.errstate(divide="ignore", invalid="ignore"):
        cpu, memory = node["available_cpu_cores"], node["available_memory_gb"]
        return {"efficiency": node["node_efficiency_score"], "lean": node["used_cpu"] / cpu - node["used_memory"] / memory,
                "core": 1.0 / cpu, "gb": 1.0 / memory}


def node_bound(job: dict, low: dict, high: dict) -> np.ndarray:
    """What ``node_scores`` can be at most between the parts ``low`` and ``high``."""
    cores, gb = job["cpu_cores_required"], job["memory_gb_required"]
    core, size = sorted_pair(cores * low["core"], cores * high["core"]), sorted_pair(gb * low["gb"], gb * high["gb"])
    apart = np.maximum(np.maximum(low["lean"] + core[0] - size[1], size[0] - core[1] - high["lean"]), 0.0)
    return (1.0 - apart) * W_BALANCE + high["efficiency"] * W_NODE_EFF + (job["priority"] / 10.0) * W_PRIORITY


def power_scores(job: dict, node: dict) -> np.ndarray:
    return node["node_efficiency_score"]


def power_parts(node: dict) -> dict:
    return {"efficiency": node["node_efficiency_score"], "left": node["available_power_watts"] - node["used_power"]}


def most_efficient(job: dict, low: dict, high: dict) -> np.ndarray:
    return high["efficiency"]


LIKE = Likeness(demand_parts, node_bound, ("priority",))
LIKE_POWER = Likeness(power_parts, most_efficient)
INDEX_BY = ["node_efficiency_score"]


def power_bound(job: dict, low: dict, high: dict) -> np.ndarray:
    return high["node_efficiency_score"] + 0.0 * job["cpu_cores_required"]


def place(jobs: DataFrame, nodes: DataFrame, objective: str):
    """Placement for one objective; returns (placements, node state)."""
    scores, like = (power_scores, LIKE_POWER) if objective == "power" else (node_scores, LIKE)
    return place_jobs(allocation_jobs(jobs), allocation_nodes(nodes), DIMS, queue_order(objective), scores, like)


def _side_by_side(run: Callable) -> list:
    """``run`` of every objective: they are independent, so three driver threads submit them and they share the cluster
    (Spark's scheduler is thread-safe)."""
    with ThreadPoolExecutor(max_workers=len(OBJECTIVES)) as pool:
        return list(pool.map(run, OBJECTIVES))


def placement_maximality(jobs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Per request and objective the number of unplaced jobs that still fit on a node."""
    j, out = allocation_jobs(jobs), None
    requests = j.select("request_id").distinct()
    for objective, (placed, state) in zip(OBJECTIVES, _side_by_side(lambda o: place(jobs, nodes, o))):
        left = still_fitting(j, placed, state, DIMS).groupBy("request_id").agg(F.count(F.lit(1)).alias("n"))
        rows = requests.join(left, "request_id", "left").select(
            "request_id", F.lit(objective).alias("objective"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n_still_fitting"))
        out = rows if out is None else out.unionByName(rows)
    return out


# ---- views at empty usage (feasibility, scores, best node) ---------------------------

def feasible_counts(jobs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Number of feasible nodes per job at empty usage; nodes are counted per demand vector."""
    j = allocation_jobs(jobs)
    per = node_counts(demand_vectors(j, DIMS), allocation_nodes(nodes), DIMS)
    return j.join(per, vector_key(DIMS)).select("request_id", "job_id", "n_feasible_nodes")


def first_choice(jobs: DataFrame, nodes: DataFrame, objective: str = "efficiency") -> DataFrame:
    """Every job with its best node and score at empty usage."""
    j = allocation_jobs(jobs)
    power = objective == "power"
    best = best_nodes(demand_vectors(j, DIMS), allocation_nodes(nodes), DIMS, power_scores if power else demand_scores,
                      power_bound if power else demand_bound, INDEX_BY)
    chosen = j.join(best, vector_key(DIMS))
    return chosen if power else chosen.withColumn("score", F.col("score") + priority_bonus())


# ---- metrics over a placement -----------------------------------------------------------

def node_usage(placements: DataFrame) -> DataFrame:
    return placements.groupBy("request_id", "node_id").agg(
        F.sum("cpu_cores_required").alias("used_cpu"), F.sum("memory_gb_required").alias("used_memory"),
        F.sum("gpu_count_required").alias("used_gpu"), F.sum("power_watts_estimated").alias("used_power"),
        F.sum("network_bandwidth_gbps").alias("used_bandwidth"))


def resource_utilization(placements: DataFrame, nodes: DataFrame) -> DataFrame:
    """used / available per request for cpu, memory, gpu, power (0 when nothing is available)."""
    cap = nodes.groupBy("request_id").agg(
        F.sum("available_cpu_cores").alias("_c"), F.sum("available_memory_gb").alias("_m"),
        F.sum("available_gpu_count").alias("_g"), F.sum("available_power_watts").alias("_p"))
    use = placements.groupBy("request_id").agg(
        F.sum("cpu_cores_required").alias("_uc"), F.sum("memory_gb_required").alias("_um"),
        F.sum("gpu_count_required").alias("_ug"), F.sum("power_watts_estimated").alias("_up"))
    t = cap.join(use, "request_id", "left")
    r = lambda u, c: F.coalesce(F.try_divide(F.coalesce(F.col(u), F.lit(0)), F.col(c)), F.lit(0.0))
    return t.select("request_id", r("_uc", "_c").alias("cpu_utilization"), r("_um", "_m").alias("memory_utilization"),
                    r("_ug", "_g").alias("gpu_utilization"), r("_up", "_p").alias("power_utilization"))


def plan_summary(placements: DataFrame, jobs: DataFrame, nodes: DataFrame, objective: str) -> DataFrame:
    """One row per request: efficiency score of the objective, utilisation, power, makespan, counts."""
    j = allocation_jobs(jobs)
    submitted = j.groupBy("request_id").agg(F.count(F.lit(1)).alias("n_jobs"), F.sum("priority").alias("_prio_all"))
    p = placements.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("n_placed"), F.sum("priority").alias("_prio_placed"),
        F.sum(F.col("priority") * F.col("runtime_hours")).alias("_work"),
        F.sum("power_watts_estimated").alias("power_consumption"),
        F.max("runtime_hours").alias("_makespan"))
    t = submitted.join(p, "request_id", "left").join(resource_utilization(placements, nodes), "request_id", "left")
    n_placed = F.coalesce(F.col("n_placed"), F.lit(0))
    priority_eff = F.when(n_placed == 0, 0.0).otherwise(
        F.least(F.lit(1.0), F.coalesce(F.try_divide(F.col("_prio_placed"), F.col("_prio_all")), F.lit(0.0))))
    throughput = F.coalesce(F.try_divide(n_placed, F.col("n_jobs")), F.lit(0.0))
    power_eff = F.when(n_placed == 0, 0.0).otherwise(
        F.coalesce(F.try_divide(F.col("_work"), F.col("power_consumption")), F.lit(0.0)))
    eff = {"efficiency": priority_eff, "throughput": throughput, "power": power_eff}[objective]
    power = F.coalesce(F.col("power_consumption"), F.lit(0.0))
    mean_util = (F.col("cpu_utilization") + F.col("memory_utilization") + F.col("gpu_utilization")
                 + F.col("power_utilization")) / 4
    balanced = W_OBJ_EFF * eff + W_OBJ_UTIL * mean_util + W_OBJ_POWER * (1.0 / (power + 1))
    return t.select(
        "request_id", F.lit(objective).alias("objective"), F.col("n_jobs"), n_placed.alias("n_placed"),
        priority_eff.alias("priority_efficiency"), throughput.alias("throughput_score"),
        power_eff.alias("power_efficiency"), eff.alias("efficiency_score"),
        "cpu_utilization", "memory_utilization", "gpu_utilization", "power_utilization",
        power.alias("power_consumption"), F.coalesce(F.col("_makespan"), F.lit(0.0)).alias("makespan_hours"),
        balanced.alias("balanced_score"))


def pick_objective(summaries: DataFrame) -> DataFrame:
    """Per request the plan with the best balanced score; ties follow OBJECTIVES order."""
    rank = F.expr("array_position(array(" + ", ".join(f"'{o}'" for o in OBJECTIVES) + "), objective)")
    w = Window.partitionBy("request_id").orderBy(F.col("balanced_score").desc(), rank)
    return summaries.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def advice(summary: DataFrame) -> DataFrame:
    """Recommendation messages from the summary thresholds (array, in the reference's order)."""
    mean_util = (F.col("cpu_utilization") + F.col("memory_utilization") + F.col("gpu_utilization")
                 + F.col("power_utilization")) / 4
    unplaced = F.col("n_jobs") - F.col("n_placed")
    msgs = F.array_compact(F.array(
        F.when(mean_util < LOW_UTIL, F.lit(MSG_LOW_UTIL)).when(mean_util > HIGH_UTIL, F.lit(MSG_HIGH_UTIL)),
        F.when(F.col("efficiency_score") < LOW_EFFICIENCY, F.lit(MSG_LOW_EFF)),
        F.when(F.col("power_consumption") > HIGH_POWER, F.lit(MSG_HIGH_POWER)),
        F.when(unplaced > 0, F.concat(unplaced.cast("string"), F.lit(MSG_UNPLACED))),
    ))
    return summary.select("request_id", "objective", msgs.alias("recommendations"))


def allocation_times(placements: DataFrame, start: Column) -> DataFrame:
    """Start (a parameter, not the clock) and completion = start + runtime hours."""
    return placements.select("request_id", "job_id", "node_id", start.alias("estimated_start_time"),
                             add_hours(start, F.col("runtime_hours")).alias("estimated_completion_time"))


def placement_details(placements: DataFrame, nodes: DataFrame) -> DataFrame:
    n = nodes.select("request_id", "node_id", F.col("node_efficiency_score").alias("allocation_efficiency"))
    return placements.join(n, ["request_id", "node_id"]).select(
        "request_id", "job_id", F.col("node_id").alias("allocated_node_id"),
        F.col("cpu_cores_required").alias("allocated_cpu_cores"),
        F.col("memory_gb_required").alias("allocated_memory_gb"),
        F.col("gpu_count_required").alias("allocated_gpu_count"), "allocation_efficiency")


def unplaced_jobs(jobs: DataFrame, placements: DataFrame) -> DataFrame:
    return allocation_jobs(jobs).select("request_id", "job_id").join(
        placements.select("request_id", "job_id"), ["request_id", "job_id"], "left_anti")


def place_balanced(jobs: DataFrame, nodes: DataFrame):
    """Run the three objectives, pick the best per request; return (placements, summaries, choice)."""
    j = allocation_jobs(jobs)

    def run(o):
        p = cut_lineage(place(j, nodes, o)[0], "placed")  # read for the summary and for the choice
        return p.withColumn("objective", F.lit(o)), plan_summary(p, j, nodes, o)

    results = _side_by_side(run)
    plans = [r[0] for r in results]
    sums = [r[1] for r in results]
    allp = plans[0].unionByName(plans[1]).unionByName(plans[2])
    alls = cut_lineage(sums[0].unionByName(sums[1]).unionByName(sums[2]), "summaries")  # one row a request and objective
    choice = pick_objective(alls)
    chosen = allp.join(choice.select("request_id", "objective"), ["request_id", "objective"], "left_semi")
    return chosen, alls, choice


def optimize(jobs: DataFrame, nodes: DataFrame, objective: str):
    """Objective registry: name -> placement; unknown names fall back to balanced."""
    if objective in OBJECTIVES:
        p, _ = place(jobs, nodes, objective)
        return p.withColumn("objective", F.lit(objective))
    chosen, _, _ = place_balanced(jobs, nodes)
    return chosen
