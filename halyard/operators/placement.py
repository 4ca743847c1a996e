"""Placement of many job batches at once (``request_id`` key), exactly as one job after the other would be placed.

The reference takes a request's jobs in queue order; each goes to the feasible node of the best score (ties: lowest
node ordinal), which then has less left.  Only the jobs that find a node change anything, and capacity only shrinks,
so a job that fits on no node now never will.  Two steps alternate until no job is left that fits:

* everywhere at once: the distinct demand vectors that still fit on some node of their request are kept (and, with
  quotas, the jobs that their user's quota still allows); all other jobs are out for good;
* a reservation: of each request the next jobs in queue order that passed, about 1,024 at first, four times as many
  every time, 262,144 at most, are decided one after the other by one task.  It holds the request's nodes in blocks of
  like ones, formed anew from time to time; a job looks at the few blocks that its best node can be in, and of what
  equal jobs before it saw only at the blocks that have changed.

The prefix is found from counts per block of 256 queue ranks, so no task ever reads a whole queue, and what a task
holds is bounded by the prefix and the nodes of one request.  Many requests are decided in parallel; jobs of one request
that compete for the same nodes cannot be, for the plan would differ.

The queue is ranked and written once.  Every step writes one table of the vectors still open and one of the
decisions with the nodes' new state (and users' charges) to the shared checkpoint folder, so lineage stays flat and
a lost executor repeats one step at most.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from halyard.operators.dominance import node_counts
from halyard.operators.prefix import running_totals
from halyard.session import cut_lineage


BLOCK = 256                         # queue ranks counted together
FIRST_PREFIX, MOST = 1024, 262_144  # jobs of a request that a task decides
SIDE = 32                           # nodes of a block
RENEW = 2048                        # placements after which blocks are formed anew
KNOWN = 1 << 20                     # blocks of which jobs' best scores are kept
SLACK = 1e-9                        # bounds are computed in another order than scores


@dataclass(frozen=True)
class Quota:
    limit: str          # job column, null: unlimited
    demand: str | None  # job column, None: one a job
    charged: str        # name of what the user holds

    def allows(self, charged: Column) -> Column:
        own = F.lit(1) if self.demand is None else F.col(self.demand)
        return F.col(self.limit).isNull() | (charged + own <= F.col(self.limit))


@dataclass(frozen=True)
class Dim:
    demand: str    # job column
    capacity: str  # node column (capacity at the start)
    used: str      # node state column (placed so far)

    @property
    def residual(self) -> Column:
        return F.col(self.capacity) - F.col(self.used)


def init_state(nodes: DataFrame, dims: list[Dim], extra_cols=()) -> DataFrame:
    """Node state: capacities, used amounts (0) and placed count."""
    cols = [F.col("request_id"), F.col("node_id"), F.col("node_ordinal"), *[F.col(c) for c in extra_cols]]
    cols += [F.col(d.capacity) for d in dims]
    cols += [F.lit(0).cast(nodes.schema[d.capacity].dataType).alias(d.used) for d in dims]
    cols.append(F.lit(0).cast("bigint").alias("n_placed"))
    return nodes.select(*cols)


def vector_key(dims: list[Dim]) -> list[str]:
    return ["request_id", *[d.demand for d in dims]]


def demand_vectors(jobs: DataFrame, dims: list[Dim]) -> DataFrame:
    """Distinct demands per request with their number of jobs."""
    return jobs.groupBy(*vector_key(dims)).agg(F.count(F.lit(1)).alias("_jobs"))


def feasible(vectors: DataFrame, state: DataFrame, dims: list[Dim], extra: Column | None = None) -> DataFrame:
    """(demand vector, node) pairs where the residual capacity covers the demand."""
    fits = F.col("request_id") == F.col("_request")
    for d in dims:
        fits = fits & (d.residual >= F.col(d.demand))
    if extra is not None:
        fits = fits & extra
    return vectors.join(state.withColumnRenamed("request_id", "_request"), fits).drop("_request")


def admit(chosen: DataFrame, state: DataFrame, dims: list[Dim], order: list[Column]) -> DataFrame:
    """Jobs whose running demand on their chosen node (queue order) fits its residual capacity."""
    run = running_totals(chosen, ["request_id", "node_id"], order, [d.demand for d in dims])
    s = state.select("request_id", "node_id", *[d.residual.alias(f"_res_{d.demand}") for d in dims])
    fits = F.lit(True)
    for d in dims:
        fits = fits & (F.col(f"cum_{d.demand}") <= F.col(f"_res_{d.demand}"))
    return run.join(s, ["request_id", "node_id"]).withColumn("admitted", fits) \
        .drop(*[f"cum_{d.demand}" for d in dims], *[f"_res_{d.demand}" for d in dims])


@dataclass(frozen=True)
class Likeness:
    """What bounds a score: ``parts(node)`` are quantities of the nodes, ``bound(job, low, high)`` is what the score can be
    at most between their least and greatest values.  Nodes that are near in the parts ``by`` share a block."""
    parts: Callable   # node arrays -> {name: array}
    bound: Callable
    needs: tuple[str, ...] = ()  # job columns of score and bound besides the demands


def sorted_pair(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.minimum(a, b), np.maximum(a, b)


def alike(parts: np.ndarray) -> np.ndarray:
    """An order in which every SIDE nodes are near in their parts: halves by the widest part, over and over."""
    usable = np.where(np.isfinite(parts), parts, 0.0)
    usable /= np.maximum(usable.std(axis=1, keepdims=True), 1e-300)
    todo, out = [np.arange(parts.shape[1])], []
    while todo:
        at = todo.pop()
        own = usable[:, at]
        width = own.max(axis=1, initial=-np.inf) - own.min(axis=1, initial=np.inf)
        if len(at) <= SIDE or not width.max() > 0:
            out.append(np.sort(at))
            continue
        half = SIDE * (-(-len(at) // SIDE) // 2)
        order = np.argpartition(own[width.argmax()], half)
        todo += [at[order[half:]], at[order[:half]]]
    return np.concatenate(out)


class At(dict):
    """The node columns at some places, each taken when it is asked for."""

    def __init__(self, node: dict, at: np.ndarray):
        super().__init__()
        self.node, self.at = node, at

    def __missing__(self, c: str) -> np.ndarray:
        self[c] = out = self.node[c][self.at]
        return out


class Blocks:
    """The open nodes that have at least ``least`` left, in blocks of nodes that are like each other.

    Of a block the most that is left and the least and greatest parts are known.  A job looks at blocks in order of what
    its score can be there and stops when no block is left that reaches the best score found.
    """

    def __init__(self, node: dict, dims: list[Dim], like: Likeness, least: np.ndarray):
        self.node, self.dims, self.like = node, dims, like
        left = self.left_of(slice(None))
        places = np.flatnonzero(node["_open"].astype(bool) & (left >= least).all(axis=0))
        blocks = -(-len(places) // SIDE)
        parts = {c: np.asarray(v, float) for c, v in like.parts(At(node, places)).items()}
        places = places[alike(np.stack(list(parts.values())))]
        pad = blocks * SIDE - len(places)
        self.at = np.concatenate([places, np.repeat(places[-1:], pad)]).reshape(blocks, SIDE)
        self.place = dict(zip(places.tolist(), range(len(places))))
        self.left = left[:, self.at]
        if pad:
            self.left[:, -1, -pad:] = -np.inf
        self.parts = np.stack([np.asarray(v, float) for v in like.parts(At(node, self.at)).values()])
        self.names = list(parts)
        self.most, self.low, self.high = self.left.max(axis=2), self.parts.min(axis=2), self.parts.max(axis=2)
        self.known, self.clock, self.stamp = {}, 0, np.zeros(blocks, np.int64)

    def left_of(self, at) -> np.ndarray:
        return np.stack([np.asarray(self.node[d.capacity][at] - self.node[d.used][at], float) for d in self.dims])

    def changed(self, n: int) -> None:
        """Node ``n`` has less left."""
        b, i = divmod(self.place[n], SIDE)
        self.left[:, b, i] = [self.node[d.capacity][n] - self.node[d.used][n] for d in self.dims]
        self.parts[:, b, i] = [v[0] for v in self.like.parts(At(self.node, slice(n, n + 1))).values()]
        self.most[:, b] = self.left[:, b].max(axis=1)
        self.low[:, b], self.high[:, b] = self.parts[:, b].min(axis=1), self.parts[:, b].max(axis=1)
        self.clock += 1
        self.stamp[b] = self.clock

    def best(self, key: tuple, job: dict, demand: np.ndarray, score: Callable) -> tuple[int, float] | None:
        """The node of the best score and the score; of equal ones the first, and one without a number before all.

        What is known of the blocks is kept by ``key`` (the job's values that count) until a block changes.
        """
        if key not in self.known:
            if len(self.known) * len(self.at) >= KNOWN:
                self.known.clear()
            blocks = len(self.at)
            self.known[key] = -1, np.empty(blocks), np.empty(blocks, bool), np.empty(blocks, np.int64)
        seen, limit, exact, first = self.known[key]
        self.known[key] = self.clock, limit, exact, first
        new = np.flatnonzero(self.stamp > seen)
        if len(new):
            with np.errstate(divide="ignore", invalid="ignore"):
                bound = self.like.bound(job, *(dict(zip(self.names, v[:, new])) for v in (self.low, self.high)))
            bound = np.where(np.isnan(bound), np.inf, bound + SLACK * (1.0 + np.abs(bound)))
            room = (self.most[:, new] >= demand).all(axis=0)
            limit[new], exact[new] = np.where(room, bound, -np.inf), ~room
        size = 8
        while True:
            top = limit.max(initial=-np.inf, where=exact)
            going = np.flatnonzero(~exact & (limit >= top))
            if not len(going):
                break
            if len(going) > size:
                going = going[np.argpartition(limit[going], -size)[-size:]]
            at, fits = self.at[going], (self.left[:, going] >= demand[:, :, None]).all(axis=0)
            ranked = np.full(at.shape, -np.inf)
            if fits.any():
                scores = score(job, At(self.node, at[fits]))
                ranked[fits] = np.where(np.isnan(scores), np.inf, scores)
            most = ranked.max(axis=1)
            limit[going], exact[going] = most, True
            first[going] = np.where(ranked == most[:, None], at, len(self.node["_open"])).min(axis=1)
            size *= 8
        if top == -np.inf:
            return None
        n = int(first[limit == top].min())
        return n, float(top if top < np.inf else score(job, At(self.node, slice(n, n + 1)))[0])


def reserve(jobs: pa.Table, nodes: pa.Table, schema: pa.Schema, dims: list[Dim], score: Callable, like: Likeness,
            quotas: tuple[Quota, ...]) -> pa.Table:
    """Decide a request's ``jobs`` (in order of queue_rank) on its ``nodes``; see ``place_jobs`` for the rows that come out."""
    jobs, nodes = jobs.sort_by("queue_rank"), nodes.sort_by("node_ordinal")
    wanted = {c: jobs[c].to_pylist() for c in jobs.column_names if c not in ("request_id", "_until", "_beyond")}
    node = {c: nodes[c].to_numpy(zero_copy_only=False).copy() for c in nodes.column_names if pa.types.is_primitive(nodes.schema.field(c).type)}
    ids, charged, full, blocks, placed = nodes["node_id"].to_pylist(), {}, set(), None, 0
    out: dict[str, list] = {c: [] for c in ("queue_rank", "node_id", "score")}
    demands = np.stack([np.asarray(jobs[d.demand].to_numpy(), float) for d in dims])
    least = np.fmin.reduce(demands, axis=1, initial=np.inf)[:, None]
    vectors = list(zip(*(wanted[d.demand] for d in dims)))
    for i, vector in enumerate(vectors if len(nodes) else ()):
        if vector in full:  # what fitted nowhere never will
            continue
        job = {c: v[i] for c, v in wanted.items()}
        if quotas:
            held = charged.get(job["user_id"]) or [job[q.charged] for q in quotas]
            after = [h + (1 if q.demand is None else job[q.demand]) for q, h in zip(quotas, held)]
            if any(job[q.limit] is not None and a > job[q.limit] for q, a in zip(quotas, after)):
                continue
        if blocks is None or placed == RENEW:
            blocks, placed = Blocks(node, dims, like, least), 0
        chosen = blocks.best((*vector, *(job[c] for c in like.needs)), job, demands[:, i:i + 1], score)
        if chosen is None:
            full.add(vector)
            continue
        if quotas:
            charged[job["user_id"]] = after
        n, value = chosen
        for d in dims:
            node[d.used][n] += job[d.demand]
        node["n_placed"][n] += 1
        placed += 1
        blocks.changed(n)
        for c, v in (("queue_rank", job["queue_rank"]), ("node_id", ids[n]), ("score", value)):
            out[c].append(v)
    request = (jobs if len(jobs) else nodes)["request_id"][0].as_py() if len(jobs) or len(nodes) else None
    tables = [pa.table({"kind": ["job"] * len(out["score"]), "request_id": [request] * len(out["score"]), **out})]
    state = {c: nodes[c] if c not in {d.used for d in dims} | {"n_placed"} else pa.array(node[c]) for c in nodes.column_names}
    beyond = jobs["_beyond"][0].as_py() if len(jobs) else 0
    until = (jobs if len(jobs) else nodes)["_until"][0].as_py()  # without candidates it stands where it stood
    state |= {"kind": ["node"] * len(nodes), "_beyond": [beyond] * len(nodes), "_until": [until] * len(nodes)}
    tables.append(pa.table(state))
    if quotas:
        tables.append(pa.table({"kind": ["user"] * len(charged), "request_id": [request] * len(charged), "user_id": list(charged),
                                **{q.charged: [v[k] for v in charged.values()] for k, q in enumerate(quotas)}}))
    return pa.concat_tables([pa.table([t[f.name].cast(f.type) if f.name in t.column_names else pa.nulls(len(t), f.type) for f in schema], schema=schema)
                             for t in tables])


def place_jobs(jobs: DataFrame, nodes_state: DataFrame, dims: list[Dim], order: list[Column], score: Callable, like: Likeness,
               extra: Callable[[], Column] | None = None, quotas: tuple[Quota, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Place the jobs of every request one after the other; return (placements, final node state).

    ``score(job, nodes)`` gives the scores of the feasible nodes: ``job`` has the job's values, ``nodes`` numpy arrays of
    the node columns; ``like`` bounds them.  With ``quotas`` a job must also fit its user's limits on top of what the user's placed jobs hold.
    ``placements`` has every job column plus node_id, score and queue_rank.
    """
    key, job_cols = vector_key(dims), jobs.columns
    queue = cut_lineage(running_totals(jobs, ["request_id"], order, rank_col="queue_rank"), "queue")
    exact = [f.name for f in nodes_state.schema if isinstance(f.dataType, T.DecimalType)]
    nodes_state = nodes_state.withColumns({c: F.col(c).cast("double") for c in exact}) if exact else nodes_state
    start = nodes_state.withColumn("_open", F.coalesce(extra(), F.lit(False)) if extra else F.lit(True))
    state = start.withColumn("_until", F.lit(None).cast("long")).withColumn("_beyond", F.lit(0).cast("long"))
    held = {q.charged: queue.schema[q.demand].dataType if q.demand else T.LongType() for q in quotas}
    fields = [T.StructField("kind", T.StringType()), T.StructField("queue_rank", T.LongType()), T.StructField("score", T.DoubleType()),
              *[T.StructField(f.name, f.dataType) for f in state.schema]]
    if quotas:
        wide = {T.IntegerType(): T.LongType()}
        fields += [T.StructField("user_id", jobs.schema["user_id"].dataType), *[T.StructField(c, wide.get(t, t)) for c, t in held.items()]]
    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)

    def decide(chunk: pa.Table, nodes: pa.Table) -> pa.Table:
        return reserve(chunk, nodes, arrow, dims, score, like, quotas)
    needed = dict.fromkeys([*key, "queue_rank", *like.needs, *(["user_id"] if quotas else []),
                            *[c for q in quotas for c in (q.limit, q.demand, q.charged) if c], "_until", "_beyond"])
    open_vectors, rounds, size, passed = demand_vectors(queue, dims).select(*key), [], FIRST_PREFIX, 0
    while True:
        open_vectors = cut_lineage(node_counts(open_vectors, state, dims, F.col("_open")).select(*key), "open")
        waiting = queue.where(F.col("queue_rank") > passed).join(open_vectors, key)
        if rounds:
            waiting = waiting.join(done, "request_id").where(F.col("_until").isNull() | (F.col("queue_rank") > F.col("_until"))).drop("_until")
        if quotas:
            waiting = _allowed(waiting, rounds, quotas, schema)
        blocks = waiting.groupBy("request_id", F.floor((F.col("queue_rank") - 1) / BLOCK).alias("_block")).agg(F.count(F.lit(1)).alias("_n"))
        before = Window.partitionBy("request_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        prefix = blocks.withColumn("_in", F.coalesce(F.sum("_n").over(before), F.lit(0)) < size).groupBy("request_id") \
            .agg(((F.max(F.when(F.col("_in"), F.col("_block"))) + 1) * BLOCK).cast("long").alias("_until"),
                 F.coalesce(F.sum(F.when(~F.col("_in"), F.col("_n"))), F.lit(0)).alias("_beyond"))
        prefix = cut_lineage(prefix, "prefix")
        last = prefix.agg(F.max("_until")).first()[0]  # the queue's files lie in order of rank: those of other ranks are not read
        chunk = waiting.where(F.col("queue_rank") <= F.lit(last).cast("long")).join(prefix, "request_id").where("queue_rank <= _until").select(*needed)
        decided = cut_lineage(chunk.groupBy("request_id").cogroup(state.groupBy("request_id")).applyInArrow(decide, schema), "decided")
        rounds.append(decided)
        state = decided.where("kind = 'node'").select(*state.columns)
        done = state.groupBy("request_id").agg(F.max("_until").alias("_until"))
        beyond, passed = decided.where("kind = 'node'").agg(F.coalesce(F.sum("_beyond"), F.lit(0)), F.coalesce(F.min("_until"), F.lit(0))).first()
        if beyond == 0:
            break
        size = min(4 * size, MOST)
    won = None
    for decided in rounds:
        part = decided.where("kind = 'job'").select("request_id", "queue_rank", "node_id", "score")
        won = part if won is None else won.unionByName(part)
    placed = queue.join(won, ["request_id", "queue_rank"]).select(*job_cols, "node_id", "score", "queue_rank")
    return placed, state.select(*nodes_state.columns)


def _allowed(waiting: DataFrame, rounds: list[DataFrame], quotas: tuple[Quota, ...], schema: T.StructType) -> DataFrame:
    """Jobs that their user's quota allows on top of what it holds, with the amounts held."""
    names = [q.charged for q in quotas]
    if rounds:
        every = None
        for i, decided in enumerate(rounds):
            part = decided.where("kind = 'user'").select("request_id", "user_id", F.lit(i).alias("_i"), *names)
            every = part if every is None else every.unionByName(part)
        last = every.groupBy("request_id", "user_id").agg(F.max(F.struct("_i", *names)).alias("_u")) \
            .select("request_id", "user_id", *[f"_u.{c}" for c in names])
        waiting = waiting.join(last, ["request_id", "user_id"], "left")
    for q in quotas:
        have = F.coalesce(F.col(q.charged), F.lit(0)) if rounds else F.lit(0)
        waiting = waiting.withColumn(q.charged, have.cast(schema[q.charged].dataType)).where(q.allows(F.col(q.charged)))
    return waiting


def still_fitting(jobs: DataFrame, placements: DataFrame, state: DataFrame, dims: list[Dim],
                  extra: Column | None = None) -> DataFrame:
    """Unplaced jobs that fit on some node of their request in the final state (none after ``place_jobs``)."""
    fits = node_counts(demand_vectors(jobs, dims), state, dims, extra).select(*vector_key(dims))
    placed = placements.select("request_id", "job_id")
    return jobs.join(fits, vector_key(dims), "left_semi").join(placed, ["request_id", "job_id"], "left_anti")
