"""Which nodes fit a demand vector, and the best of them, without looking at every (vector, node) pair.

A request's nodes are indexed in tiles of at most 4,096.  For every dimension the nodes are sorted by what they have
left, and for every rank one bitmap says which nodes have at least that much: a demand is looked up by binary search, and
the nodes that fit it are the bitwise AND of one row per dimension.  Counting them is a population count.

The best node is found by branch and bound.  Nodes stand in the order of the columns that decide most about a score, in
blocks of 32, with the least and greatest value of every column; a score's upper bound follows from these intervals.  A vector
visits blocks in order of their bounds, scores the fitting nodes of one block at a time and stops when no bound is left
that reaches the best score found; ties go to the lowest node ordinal.

In Spark, a request's vectors are dealt in groups of about 50,000, each with the request's nodes beside it, so a
request with very many distinct demands is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

TILE, BLOCK = 4096, 32
VECTORS = 50_000     # vectors of a group
SLACK = 1e-9         # bounds are computed in another order than scores

Arrays = dict[str, np.ndarray]


class Tile:
    """The index of at most TILE nodes; ``node`` holds the numeric columns in the order of the blocks."""

    def __init__(self, node: Arrays, capacity: list[str], used: list[str], by: list[str]):
        order = np.lexsort([node[c] for c in by[::-1]] or [node["node_ordinal"]])
        self.node = {c: v[order] for c, v in node.items()}
        n = len(order)
        self.blocks = -(-n // BLOCK)
        self.left = []
        for c, u in zip(capacity, used):
            left = self.node[c] - self.node[u]
            by = np.argsort(left, kind="stable")
            flags = np.zeros((n + 1, self.blocks * BLOCK), bool)
            rank = np.empty(n, np.int64)
            rank[by] = np.arange(n)
            flags[:, :n] = rank[None, :] >= np.arange(n + 1)[:, None]
            self.left.append((left[by], np.packbits(flags, axis=1, bitorder="little").view(np.uint32)))
        pad = self.blocks * BLOCK - n
        edges = {c: np.concatenate([v, np.repeat(v[-1:], pad)]).reshape(self.blocks, BLOCK) for c, v in self.node.items()}
        self.low, self.high = ({c: f(v, axis=1) for c, v in edges.items()} for f in (np.min, np.max))

    def fitting(self, demand: list[np.ndarray]) -> np.ndarray:
        """A bitmap of the nodes for each vector: one 32-bit word a block."""
        out = None
        for (left, maps), d in zip(self.left, demand):
            rows = maps[np.searchsorted(left, d, "left")]
            out = rows if out is None else out & rows
        return out


def tiles(node: Arrays, capacity: list[str], used: list[str], by: list[str] = ()) -> Iterator[Tile]:
    """The index of a request's nodes; ``by``: columns in whose order they stand in blocks."""
    for at in range(0, len(node["node_ordinal"]), TILE):
        yield Tile({c: v[at:at + TILE] for c, v in node.items()}, capacity, used, list(by))


def counted(index: list[Tile], demand: list[np.ndarray]) -> np.ndarray:
    """Number of nodes that fit each vector."""
    return sum((np.bitwise_count(t.fitting(demand)).sum(axis=1, dtype=np.int64) for t in index), np.zeros(len(demand[0]), np.int64))


def best(index: list[Tile], demand: list[np.ndarray], job: Arrays, score: Callable, bound: Callable) -> tuple[np.ndarray, np.ndarray, int]:
    """(best score or -inf, ordinal of its node, number of pairs scored) for each vector.

    ``score(job, node)`` and ``bound(job, low, high)`` take arrays that broadcast against each other.
    """
    n, scored = len(demand[0]), 0
    top, first = np.full(n, -np.inf), np.full(n, np.iinfo(np.int64).max)
    for t in index:
        fits = t.fitting(demand)
        limit = np.broadcast_to(bound({c: v[:, None] for c, v in job.items()}, {c: v[None] for c, v in t.low.items()},
                                      {c: v[None] for c, v in t.high.items()}), fits.shape)
        limit = np.where(fits != 0, limit + SLACK, -np.inf)
        going = np.arange(n)
        while True:
            block = limit[going].argmax(axis=1)
            open_ = limit[going, block] >= np.maximum(top[going], -1e300)
            going, block = going[open_], block[open_]
            if not len(going):
                break
            limit[going, block] = -np.inf
            bits = (fits[going, block][:, None] >> np.arange(BLOCK, dtype=np.uint32)) & 1
            which, place = np.nonzero(bits)
            at, vector = block[which] * BLOCK + place, going[which]
            scored += len(at)
            s = score({c: v[vector] for c, v in job.items()}, {c: v[at] for c, v in t.node.items()})
            o = t.node["node_ordinal"][at]
            order = np.lexsort((o, -s, vector))
            lead = order[np.concatenate([[True], vector[order][1:] != vector[order][:-1]])]
            v, s, o = vector[lead], s[lead], o[lead]
            better = (s > top[v]) | (s == top[v]) & (o < first[v])
            top[v[better]], first[v[better]] = s[better], o[better]
    return top, first, scored


def _grouped(vectors: DataFrame, nodes: DataFrame) -> tuple:
    """Vectors and nodes by (request_id, _group): about VECTORS vectors a group, the request's nodes in each."""
    sizes = vectors.groupBy("request_id").agg(F.count(F.lit(1)).alias("_n")).withColumn("_groups", F.ceil(F.col("_n") / VECTORS).cast("int")).drop("_n")
    dealt = vectors.join(sizes, "request_id").withColumn("_group", F.pmod(F.xxhash64(*vectors.columns), F.col("_groups")).cast("int")).drop("_groups")
    beside = nodes.join(sizes, "request_id").withColumn("_group", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1))).drop("_groups")
    return dealt.groupBy("request_id", "_group"), beside.groupBy("request_id", "_group")


def _arrays(table: pa.Table) -> Arrays:
    return {c: table[c].to_numpy(zero_copy_only=False) for c in table.column_names if pa.types.is_primitive(table.schema.field(c).type)}


def _numeric(df: DataFrame) -> DataFrame:
    exact = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in exact}) if exact else df


def node_counts(vectors: DataFrame, state: DataFrame, dims, extra: Column | None = None, out: str = "n_feasible_nodes") -> DataFrame:
    """``vectors`` (request_id and demands) that some open node of their request fits, with the number of such nodes."""
    key = ["request_id", *[d.demand for d in dims]]
    vectors = vectors.select(*key)
    nodes = _numeric(state if extra is None else state.where(extra)).select("request_id", "node_ordinal", *[c for d in dims for c in (d.capacity, d.used)])
    schema = T.StructType([*[vectors.schema[c] for c in key], T.StructField(out, T.LongType())])
    arrow, demands, capacity, used = to_arrow_schema(schema), key[1:], [d.capacity for d in dims], [d.used for d in dims]

    def count(v: pa.Table, n: pa.Table) -> pa.Table:
        if not len(v) or not len(n):
            return arrow.empty_table()
        found = counted(list(tiles(_arrays(n), capacity, used)), [v[c].to_numpy() for c in demands])
        table = v.select(key).append_column(out, pa.array(found))
        return table.filter(pa.array(found > 0)).cast(arrow)
    a, b = _grouped(vectors, nodes)
    return a.cogroup(b).applyInArrow(count, schema)


def best_nodes(vectors: DataFrame, state: DataFrame, dims, score: Callable, bound: Callable, by: list[str],
               extra: Column | None = None) -> DataFrame:
    """``vectors`` with node_id and score of the best open node that fits; those that none fits are left out."""
    key = ["request_id", *[d.demand for d in dims]]
    vectors = vectors.select(*key)
    nodes = _numeric(state if extra is None else state.where(extra))
    schema = T.StructType([*[vectors.schema[c] for c in key], T.StructField("node_id", nodes.schema["node_id"].dataType), T.StructField("score", T.DoubleType())])
    arrow, demands, capacity, used = to_arrow_schema(schema), key[1:], [d.capacity for d in dims], [d.used for d in dims]

    def pick(v: pa.Table, n: pa.Table) -> pa.Table:
        if not len(v) or not len(n):
            return arrow.empty_table()
        node, job = _arrays(n), {c: v[c].to_numpy() for c in demands}
        top, first, _ = best(list(tiles(node, capacity, used, by)), [job[c] for c in demands], job, score, bound)
        ids = dict(zip(node["node_ordinal"].tolist(), n["node_id"].to_pylist()))
        names = pa.array([ids.get(o) for o in first.tolist()], arrow.field("node_id").type)
        table = v.select(key).append_column("node_id", names).append_column("score", pa.array(top))
        return table.filter(pa.array(np.isfinite(top))).cast(arrow)
    a, b = _grouped(vectors, nodes)
    return a.cogroup(b).applyInArrow(pick, schema)
