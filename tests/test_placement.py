"""The placement equals the loop over single jobs, whatever the prefixes."""

import pytest

from halyard.operators import allocation as A
from halyard.operators import placement as P
from halyard.operators import scheduling as SC
from halyard.sources import fixtures as X


def rank(rows, order):
    return sorted(rows, key=order)


def loop(jobs, nodes, dims, score, is_open=lambda n: True, quotas=None):
    """One job after the other, as the services do it: {job_id: node_id}."""
    used = {n["node_id"]: {d.used: 0 for d in dims} | {"n_placed": 0} for n in nodes}
    held, out = {}, {}
    for j in jobs:
        mine = held.setdefault(j["user_id"], [0, 0.0, 0]) if quotas else None
        after = [mine[0] + j["cpu_cores_required"], mine[1] + j["memory_gb_required"], mine[2] + 1] if quotas else None
        limits = quotas.get(j["user_id"]) if quotas else None
        if limits and any(x is not None and a > x for a, x in zip(after, limits)):
            continue
        best, best_score = None, -1
        for n in nodes:
            u = used[n["node_id"]]
            if is_open(n) and all(n[d.capacity] >= j[d.demand] + u[d.used] for d in dims):
                s = score(j, n, u)
                if s > best_score:
                    best, best_score = n["node_id"], s
        if best is not None:
            out[j["job_id"]] = best
            for d in dims:
                used[best][d.used] += j[d.demand]
            used[best]["n_placed"] += 1
            if quotas:
                held[j["user_id"]] = after
    return out


def fits(j, n, u):
    cpu = (j["cpu_cores_required"] + u["used_cpu"]) / n["available_cpu_cores"]
    memory = (j["memory_gb_required"] + u["used_memory"]) / n["available_memory_gb"]
    return (1.0 - abs(cpu - memory)) * 0.4 + n["node_efficiency_score"] * 0.4 + j["priority"] / 10.0 * 0.2


def balance(j, n, u):
    cpu = j["cpu_cores_required"] / (n["available_cpu_cores"] - u["used_cpu"])
    memory = j["memory_gb_required"] / (n["available_memory_gb"] - u["used_memory"])
    return (1.0 - abs(cpu - memory)) * 0.6 + (1.0 if u["n_placed"] == 0 else 0.5) * 0.4


@pytest.fixture(params=[None, (16, 40)])
def prefixes(request, monkeypatch):
    """The real prefixes, and ones so short that every request takes many steps."""
    if request.param:
        monkeypatch.setattr(P, "BLOCK", request.param[0])
        monkeypatch.setattr(P, "FIRST_PREFIX", request.param[1])
        monkeypatch.setattr(P, "MOST", 2 * request.param[1])


def by_request(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["request_id"], []).append(r.asDict())
    return out


def test_allocation_equals_the_loop(spark, sf, prefixes):
    jobs, nodes = X.jobs(spark, sf), X.nodes(spark, sf)
    every, ours = by_request(A.allocation_jobs(jobs)), by_request(nodes.orderBy("node_ordinal"))
    placed, _ = A.place(jobs, nodes, "efficiency")
    got = {r["job_id"]: r["node_id"] for r in placed.collect()}
    want = {}
    for request, rows in every.items():
        rows.sort(key=lambda j: (-j["priority"], j["runtime_hours"], j["job_ordinal"]))
        want |= loop(rows, ours.get(request, []), A.DIMS, fits)
    assert got == want and len(want) > 30


def test_fair_share_equals_the_loop(spark, sf, prefixes):
    jobs, nodes, quotas = X.jobs(spark, sf), X.nodes(spark, sf), X.user_quotas(spark, sf)
    every = by_request(SC.with_fair_key(SC.scheduler_jobs(jobs), quotas))
    ours = by_request(nodes.orderBy("node_ordinal"))
    limits = {q["user_id"]: (q["max_cpu_cores"], q["max_memory_gb"], q["max_concurrent_jobs"]) for q in quotas.collect()}
    out, _, _ = SC.schedule(jobs, nodes, quotas, "fair_share")
    got = {r["job_id"]: r["node_id"] for r in out.collect()}
    want = {}
    for request, rows in every.items():
        rows.sort(key=lambda j: (j["fair_key"], j["submission_time"], j["job_ordinal"]))
        want |= loop(rows, ours.get(request, []), SC.DIMS, balance, lambda n: n["is_available"], limits)
    assert got == want and len(want) > 30


def test_no_jobs_no_nodes(spark, sf):
    jobs, nodes = X.jobs(spark, sf), X.nodes(spark, sf)
    none, state = A.place(jobs.limit(0), nodes, "power")
    assert none.count() == 0 and state.count() == nodes.count()
    none, state = A.place(jobs, nodes.limit(0), "power")
    assert none.count() == 0 and state.count() == 0
