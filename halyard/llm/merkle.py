"""Merkle manifest of a dataset, with proofs of single rows from one multiproof a leaf partition.

Rows are the leaves of one tree a group, in order of their key; every 16 consecutive nodes become the SHA-256 of
their digests' hex text, until one node, the subroot, is left.  The subroots, in order of their groups (null first,
then by UTF-8 bytes), are the leaves of the top tree, whose last node is the root.

Building: one range shuffle orders digests (not texts); a written table of the stretches of each group in each range
gives every leaf its position.  Leaves are dealt in partitions of 4,096 consecutive positions, whole subtrees of
three levels; only their top nodes are grouped further, level by level.

Proofs (octopus multiproof): a leaf partition works out the minimal union of the node coordinates that its leaves'
proofs need and that it cannot derive itself, fetches those nodes once, derives the interiors that its leaves share
from the leaves, and expands every single proof from both.  The top tree's proof of a group is fetched with them.

Fields are written as ``-`` if null, otherwise as UTF-8 byte count, ``:`` and value.  Leaves with equal keys (null
keys first) are ordered by their digests, so repeated rows are leaves of their own.  Empty texts are values of no
bytes.  Column names are the caller's expressions only; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from halyard.session import cut_lineage

FANOUT = 16
DEPTH = 3  # levels inside a leaf partition of FANOUT ** DEPTH leaves


def digest(*fields: Column) -> Column:
    """SHA-256 (binary) over the fields in order."""
    def written(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.unhex(F.sha2(F.concat(*[written(c) for c in fields]), 256))


def parent(children: list[bytes]) -> bytes:
    return sha256(b"".join(children).hex().encode()).digest()


def levels(leaves: list[bytes], depth: int) -> list[list[bytes]]:
    """The leaves and at most ``depth`` levels above them, until one node is left."""
    out = [leaves]
    while len(out) <= depth and len(out[-1]) > 1:
        out.append([parent(out[-1][i:i + FANOUT]) for i in range(0, len(out[-1]), FANOUT)])
    return out


def coordinates(position: int, size: int) -> Iterator[tuple[int, int]]:
    """(level, index) of the siblings of the leaf at ``position`` of ``size``, level by level, left to right."""
    level = 0
    while size > 1:
        first = position - position % FANOUT
        yield from ((level, i) for i in range(first, min(first + FANOUT, size)) if i != position)
        position, size, level = position // FANOUT, -(-size // FANOUT), level + 1


def missing(chunk: int, size: int, depth: int = DEPTH) -> list[tuple[int, int]]:
    """The minimal union of coordinates that the proofs of a leaf partition need from outside: the siblings of its top."""
    return [(level + depth, i) for level, i in coordinates(chunk, -(-size // FANOUT ** depth))]


def fold(leaf: bytes, proof: bytes, *trees: tuple[int, int]) -> bytes:
    """The root that ``leaf`` and its siblings give; ``trees``: position and size in each tree, from the leaf's own upwards."""
    at = 0
    for position, size in trees:
        while size > 1:
            place = position % FANOUT
            others = min(FANOUT, size - position + place) - 1
            run = proof[at:at + 32 * others]
            leaf = parent([run[:32 * place], leaf, run[32 * place:]])
            at, position, size = at + 32 * others, position // FANOUT, -(-size // FANOUT)
    return leaf


def positioned(leaves: DataFrame) -> DataFrame:
    """``leaves`` (group, key, leaf, ...) with ``position`` in their group and ``size`` of it."""
    spread = leaves.repartitionByRange("group", "key", "leaf").sortWithinPartitions("group", "key", "leaf") \
        .withColumn("row", F.monotonically_increasing_id())
    rows = cut_lineage(spread, "leaves").withColumn("part", F.shiftright("row", 33))
    parts = rows.groupBy(F.col("group").alias("g"), F.col("part").alias("p")).agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("g")  # one row for each range partition that the group touches
    parts = parts.select("g", "p", (F.coalesce(F.sum("n").over(whole.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                                    - F.col("first")).alias("shift"), F.sum("n").over(whole).alias("size"))
    return rows.join(parts, F.col("group").eqNullSafe(F.col("g")) & (F.col("part") == F.col("p"))) \
        .withColumn("position", F.col("row") + F.col("shift")).drop("row", "part", "g", "p", "shift")


def _runs(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Consecutive rows with equal first ``width`` columns; a run is at most a leaf partition and its head."""
    key, held = None, []
    for b in batches:
        for row in zip(*[c.to_pylist() for c in b.columns]):
            if row[:width] != key:
                if held:
                    yield key, held
                key, held = row[:width], []
            held.append(row[width:])
    if held:
        yield key, held


def _out(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)


class Forest:
    """One tree a group over ``leaves``: (group, key, leaf (binary), and columns to carry)."""

    def __init__(self, leaves: DataFrame, depth: int = DEPTH):
        self.group_type, self.depth, self.chunk = leaves.schema["group"].dataType, depth, FANOUT ** depth
        self.leaves = positioned(leaves).withColumn("chunk", F.floor(F.col("position") / self.chunk).cast("long"))
        self.tops = cut_lineage(self._tops(), "tops")
        tallest = self.tops.agg(F.max("size")).first()[0] or 0
        level, width = depth, -(-tallest // self.chunk)
        now = self.tops.where(F.col("size") > self.chunk).select("group", "size", F.col("chunk").alias("index"), "node")
        self.nodes = now.select("group", F.lit(level).alias("level"), "index", "node")
        roots = self.tops.where(F.col("size") <= self.chunk).select("group", "size", "node")
        while width > 1:  # a level has a sixteenth of the nodes of the one below it; the width is the tallest tree's
            up = now.groupBy("group", "size", F.shiftright("index", 4).alias("parent")) \
                .agg(F.sort_array(F.collect_list(F.struct("index", "node"))).alias("run"))
            width, level = -(-width // FANOUT), level + 1
            hexes = F.array_join(F.transform("run", lambda x: F.lower(F.hex(x["node"]))), "")
            up = cut_lineage(up.select("group", "size", F.col("parent").alias("index"), F.unhex(F.sha2(hexes, 256)).alias("node")), "level")
            lone = F.col("size") <= FANOUT ** level
            roots = roots.unionByName(up.where(lone).drop("index"))
            now = up.where(~lone)
            self.nodes = self.nodes.unionByName(now.select("group", F.lit(level).alias("level"), "index", "node"))
        self.roots = roots  # group, size, node

    def _dealt(self, rows: DataFrame, *order: str) -> DataFrame:
        return rows.repartition("group", "chunk").sortWithinPartitions("group", "chunk", *order)

    def _tops(self) -> DataFrame:
        schema = T.StructType([T.StructField("group", self.group_type), T.StructField("chunk", T.LongType()), T.StructField("size", T.LongType()),
                               T.StructField("node", T.BinaryType()),
                               T.StructField("need", T.ArrayType(T.StructType([T.StructField("level", T.IntegerType()), T.StructField("index", T.LongType())])))])
        arrow, depth = _arrow(schema), self.depth

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for (group, chunk, size), rows in _runs(batches, 3):
                need = [{"level": level, "index": i} for level, i in missing(chunk, size, depth)]
                nodes = levels([r[0] for r in rows], depth)
                while size > FANOUT ** depth and len(nodes) <= depth:  # a last partition of few leaves still has all its levels
                    nodes.append([parent(nodes[-1])])
                yield _out([(group, chunk, size, nodes[-1][0], need)], arrow)
        dealt = self._dealt(self.leaves, "position")
        return dealt.select("group", "chunk", "size", "leaf").mapInArrow(build, schema)

    def proofs(self, above: DataFrame | None = None) -> DataFrame:
        """Each leaf with ``position``, ``size`` and ``proof`` (the siblings' digests, level by level, left to right).

        ``above``: the leaves of the tree over this one as its ``proofs`` gives them, with its ``root``.  They travel
        with the fetched nodes: their proofs are appended, and subroot, root, top_position and top_size come back.
        """
        asked = self.tops.select("group", "chunk", F.explode("need").alias("c")).select("group", "chunk", "c.level", "c.index")
        n = self.nodes.select(F.col("group").alias("g"), F.col("level").alias("l"), F.col("index").alias("i"), "node")
        fetched = asked.join(n, asked["group"].eqNullSafe(n["g"]) & (asked["level"] == n["l"]) & (asked["index"] == n["i"])) \
            .groupBy("group", "chunk").agg(F.sort_array(F.collect_list(F.struct("level", "index", "node"))).alias("nodes"))
        t = self.tops.select("group", "chunk")
        f = fetched.select(F.col("group").alias("g"), F.col("chunk").alias("c"), F.expr("transform(nodes, x -> x.node)").alias("fetched"))
        heads = t.join(f, t["group"].eqNullSafe(f["g"]) & (t["chunk"] == f["c"]), "left").drop("g", "c")
        if above is None:
            none = {"top": "binary", "top_position": "long", "top_size": "long", "subroot": "binary", "root": "binary"}
            heads = heads.withColumns({c: F.lit(None).cast(t) for c, t in none.items()})
        else:
            a = above.select(F.col("key").alias("g"), F.col("proof").alias("top"), F.col("position").alias("top_position"),
                             F.col("size").alias("top_size"), F.col("leaf").alias("subroot"), "root")
            heads = heads.join(a, heads["group"].eqNullSafe(a["g"])).drop("g")
        both = self.leaves.withColumn("late", F.lit(1)).unionByName(heads.withColumn("late", F.lit(0)), allowMissingColumns=True)
        shared = ["top_position", "top_size", "subroot", "root"]
        lead = ["group", "chunk", "late", "fetched", "top", *shared, "size", "leaf"]
        rest = [c for c in self.leaves.columns if c not in (*lead, "position")]
        fields = {f.name: T.StructField(f.name, f.dataType) for f in both.schema}
        schema = T.StructType([fields[c] for c in ["group", "size", "position", "leaf", *rest, *shared]] + [T.StructField("proof", T.BinaryType())])
        arrow, depth = _arrow(schema), self.depth

        def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for (group, chunk), (head, *rows) in _runs(batches, 2):
                outside, above_all = b"".join(head[1] or ()) + (head[2] or b""), head[3:7]
                inside = levels([r[8] for r in rows], depth - 1)
                out = []
                for place, row in enumerate(rows):
                    own, at = [], place
                    for nodes in inside:
                        first = at - at % FANOUT
                        own += nodes[first:at]
                        own += nodes[at + 1:first + FANOUT]
                        at //= FANOUT
                    out.append((group, row[7], chunk * FANOUT ** depth + place, *row[8:], *above_all, b"".join(own) + outside))
                    if len(out) == 1000:
                        yield _out(out, arrow)
                        out = []
                if out:
                    yield _out(out, arrow)
        return self._dealt(both, "late", "position").select(*lead, *rest).mapInArrow(expand, schema)


def manifest(leaves: DataFrame, depth: int = DEPTH) -> tuple[Forest, Forest]:
    """The trees of the groups of ``leaves`` (group, key, leaf, ...), and the tree of their subroots."""
    trees = Forest(leaves, depth)
    return trees, Forest(trees.roots.select(F.lit(0).alias("group"), F.col("group").alias("key"), F.col("node").alias("leaf")), depth)


def proved(leaves: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Every leaf with its subroot, the root, its place in both trees and its proof up to the root."""
    trees, top = manifest(leaves, depth)
    root = F.broadcast(top.roots.select(F.col("node").alias("root")))  # one row
    return trees.proofs(top.proofs().drop("root").join(root))
