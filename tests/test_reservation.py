"""The blocks of a reservation give the node that a look at all nodes gives, and look at few of them."""

import numpy as np
import pyarrow as pa
import pytest

from halyard.operators import allocation as A
from halyard.operators import placement as P
from halyard.operators import scheduling as SC

CASES = [(A.DIMS, A.node_scores, A.LIKE), (A.DIMS, A.power_scores, A.LIKE_POWER), (SC.DIMS, SC.node_scores, SC.LIKE)]


def tables(dims, n_jobs, n_nodes, whole, seed):
    """Jobs and nodes of one request; ``whole``: whole numbers with many ties, otherwise hardly any two are equal."""
    rng = np.random.default_rng(seed)
    value = (lambda low, high, n: rng.integers(low, high, n).astype(float)) if whole else (lambda low, high, n: rng.uniform(low, high, n))
    sizes = {d.demand: value(1, 9, n_jobs) for d in dims} | {"gpu_count_required": value(0, 2, n_jobs)}
    rooms = {d.capacity: value(20, 60, n_nodes) for d in dims} | {"available_gpu_count": value(0, 9, n_nodes)}
    jobs = {"request_id": [1] * n_jobs, "queue_rank": range(1, n_jobs + 1), "priority": rng.integers(1, 11, n_jobs),
            **sizes, "_until": [n_jobs] * n_jobs, "_beyond": [0] * n_jobs}
    nodes = {"request_id": [1] * n_nodes, "node_id": [f"n{i}" for i in range(n_nodes)], "node_ordinal": range(n_nodes),
             "node_efficiency_score": value(1, 4, n_nodes) / 4, **rooms, **{d.used: np.zeros(n_nodes) for d in dims},
             "n_placed": np.zeros(n_nodes, np.int64), "_open": np.arange(n_nodes) % 7 != 3}
    return pa.table(jobs), pa.table(nodes)


def reserved(dims, score, like, jobs, nodes):
    schema = pa.schema([("kind", pa.string()), ("queue_rank", pa.int64()), ("score", pa.float64()), *nodes.schema,
                        ("_until", pa.int64()), ("_beyond", pa.int64())])
    nodes = nodes.append_column("_until", pa.nulls(len(nodes), pa.int64()))
    rows = P.reserve(jobs, nodes, schema, dims, score, like, ()).to_pylist()
    return [(r["queue_rank"], r["node_id"], r["score"]) for r in rows if r["kind"] == "job"]


def looked_at_all(dims, score, jobs, nodes):
    node = {c: nodes[c].to_numpy().copy() for c in nodes.column_names if c != "node_id"}
    out = []
    for job in jobs.to_pylist():
        fits = node["_open"].copy()
        for d in dims:
            fits &= node[d.capacity] - node[d.used] >= job[d.demand]
        at = np.flatnonzero(fits)
        if len(at):
            s = score(job, {c: v[at] for c, v in node.items()})
            n = at[int(np.argmax(s))]
            for d in dims:
                node[d.used][n] += job[d.demand]
            node["n_placed"][n] += 1
            out.append((job["queue_rank"], f"n{n}", float(s.max())))
    return out


@pytest.mark.parametrize("dims, score, like", CASES)
@pytest.mark.parametrize("whole", [True, False])
@pytest.mark.parametrize("renew, known", [(2048, 1 << 20), (30, 40)])
def test_equals_a_look_at_all_nodes(monkeypatch, dims, score, like, whole, renew, known):
    monkeypatch.setattr(P, "RENEW", renew)
    monkeypatch.setattr(P, "KNOWN", known)
    for n_nodes in (1, 31, 33, 300):
        jobs, nodes = tables(dims, 3000, n_nodes, whole, n_nodes)
        want = looked_at_all(dims, score, jobs, nodes)
        assert reserved(dims, score, like, jobs, nodes) == want and (n_nodes < 30 or len(want) > 100)


def test_node_without_a_number_comes_first():
    jobs, nodes = tables(A.DIMS, 200, 100, True, 5)
    efficiency = nodes["node_efficiency_score"].to_numpy().copy()
    efficiency[50] = np.nan
    nodes = nodes.set_column(nodes.column_names.index("node_efficiency_score"), "node_efficiency_score", pa.array(efficiency))
    got, want = (f(A.DIMS, A.node_scores, *more, jobs, nodes) for f, more in ((reserved, (A.LIKE,)), (looked_at_all, ())))
    assert [g[:2] for g in got] == [w[:2] for w in want] and got[0][1] == "n50" and np.isnan(got[0][2])


@pytest.mark.parametrize("dims, score, like", CASES)
def test_few_nodes_are_scored(dims, score, like):
    scored = 0

    def counted(job, node):
        nonlocal scored
        s = score(job, node)
        scored += len(s)
        return s
    jobs, nodes = tables(dims, 4000, 8000, False, 3)
    assert len(reserved(dims, counted, like, jobs, nodes)) > 3900
    assert scored < .1 * 4000 * 8000
