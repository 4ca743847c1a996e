"""The node index against all pairs, and how few pairs it looks at."""

import numpy as np
import pytest

from halyard.operators import allocation as A
from halyard.operators import dominance as DX
from halyard.operators import scheduling as SC


def nodes_of(rng, n, ties=False):
    cpu = rng.integers(8, 129, n)
    node = {"available_cpu_cores": cpu, "available_memory_gb": np.round(cpu * rng.uniform(2, 8, n), 1), "available_gpu_count": rng.integers(0, 9, n),
            "available_power_watts": rng.uniform(500, 4000, n), "available_network_bandwidth_gbps": rng.uniform(1, 100, n),
            "node_efficiency_score": np.round(rng.uniform(.5, 1, n), 3), "node_ordinal": rng.permutation(n).astype(np.int64),
            "n_placed": rng.integers(0, 2, n), "used_cpu": rng.integers(0, 8, n), "used_memory": rng.uniform(0, 10, n), "used_gpu": np.zeros(n, np.int64),
            "used_power": np.zeros(n), "used_bandwidth": np.zeros(n)}
    if ties:
        node = {c: v if c == "node_ordinal" else v[rng.integers(0, min(5, n), n)] for c, v in node.items()}
    return node | {"cpu_per_gb": (node["available_cpu_cores"] - node["used_cpu"]) / (node["available_memory_gb"] - node["used_memory"])}


def demands_of(rng, n):
    cpu = rng.integers(1, 33, n)
    return {"cpu_cores_required": cpu, "memory_gb_required": np.round(cpu * rng.uniform(1, 9, n), 2), "gpu_count_required": rng.integers(0, 4, n),
            "power_watts_estimated": rng.uniform(50, 900, n), "network_bandwidth_gbps": rng.uniform(0, 20, n)}


def plain(node, job, dims, score):
    """Number of nodes, best score and its lowest ordinal for each vector, over all pairs."""
    fits = np.ones((len(job["cpu_cores_required"]), len(node["node_ordinal"])), bool)
    for d in dims:
        fits &= node[d.capacity][None] - node[d.used][None] >= job[d.demand][:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        s = np.where(fits, score({c: v[:, None] for c, v in job.items()}, {c: v[None] for c, v in node.items()}), -np.inf)
    top = s.max(axis=1, initial=-np.inf)
    first = np.where((s == top[:, None]) & fits, node["node_ordinal"][None], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
    return fits.sum(axis=1), top, first


CASES = [(A.DIMS, A.demand_scores, A.demand_bound, A.INDEX_BY), (A.DIMS, A.power_scores, A.power_bound, A.INDEX_BY),
         (SC.DIMS, SC.node_scores, SC.node_bound, SC.INDEX_BY)]


@pytest.mark.parametrize("dims, score, bound, by", CASES)
@pytest.mark.parametrize("ties", [False, True])
@pytest.mark.parametrize("n", [1, 31, 33, 400])
def test_equals_all_pairs(monkeypatch, dims, score, bound, by, ties, n):
    monkeypatch.setattr(DX, "TILE", 100)  # several tiles
    rng = np.random.default_rng(n + ties)
    node, job = nodes_of(rng, n, ties), demands_of(rng, 500)
    index = list(DX.tiles(node, [d.capacity for d in dims], [d.used for d in dims], by))
    demand = [job[d.demand] for d in dims]
    count, top, first = plain(node, job, dims, score)
    assert (DX.counted(index, demand) == count).all()
    got, ordinal, _ = DX.best(index, demand, job, score, bound)
    assert (got == top).all() and (ordinal == first).all()


@pytest.mark.parametrize("dims, score, bound, by", CASES)
def test_few_pairs_are_scored(dims, score, bound, by):
    """100,000 distinct demands and 1,000 nodes of one request: under 5 % of the pairs."""
    rng = np.random.default_rng(7)
    node, job = nodes_of(rng, 1000), demands_of(rng, 100_000)
    index = list(DX.tiles(node, [d.capacity for d in dims], [d.used for d in dims], by))
    scored = 0
    for at in range(0, 100_000, DX.VECTORS):
        part = {c: v[at:at + DX.VECTORS] for c, v in job.items()}
        scored += DX.best(index, [part[d.demand] for d in dims], part, score, bound)[2]
    assert scored < .05 * 100_000 * 1000


def test_vectors_in_several_groups(spark, monkeypatch):
    """Groups of 20 vectors give the rows of one group."""
    from halyard.sources import fixtures as X
    sf = "/root/testdata/sf0.001"
    jobs, nodes = X.jobs(spark, sf), X.nodes(spark, sf)
    want = sorted(map(tuple, A.first_choice(jobs, nodes).select("request_id", "job_id", "node_id", "score").collect()))
    counts = sorted(map(tuple, A.feasible_counts(jobs, nodes).collect()))
    monkeypatch.setattr(DX, "VECTORS", 20)
    assert sorted(map(tuple, A.first_choice(jobs, nodes).select("request_id", "job_id", "node_id", "score").collect())) == want
    assert sorted(map(tuple, A.feasible_counts(jobs, nodes).collect())) == counts
    assert A.feasible_counts(jobs, nodes.limit(0)).count() == 0 and A.first_choice(jobs.limit(0), nodes).count() == 0
