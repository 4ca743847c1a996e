"""Repair of conversation structure by Wagner-Fischer alignment against an alternating grammar.

A conversation's turns, in order, are edited until their role initials spell ``(s?(ua)+)?``: an optional system
turn and then user and assistant in alternation, or nothing.  Edits and costs: Keep 0, Rerole to user or assistant 3,
Delete 4 (the only edit for blank and duplicate turns), Insert an empty user or assistant turn 3; a truncated turn
that is not deleted adds 3.  The audit is the edits' initials in order; of the cheapest ones the ASCII-least.

Method.  A target of every feasible length is a suffix of one alternating string (with an ``s`` in front for odd
lengths), so one table of suffix costs, turn by turn from the last, holds the alignments to all lengths: the costs
of the even lengths stand in its first row, those of the odd ones in the row of a kept first ``s``.  Only a band of
diagonals is filled, as wide as the incumbent cost allows: a path inside that cost can neither insert nor delete
more.  If the best alignment in the band costs more than the band was cut for, it is the new incumbent and the band
grows (fourfold at most); otherwise it is proved the cheapest.  Every length of least cost is backtraced, and the
audits are compared.  Rows of the table are kept at about every square root of the turns and filled again between them.

Spark's part.  Turns are dealt by conversation and sorted; faults come from DataFrame expressions and a window, and
a task reads a conversation's turns as a stream, keeping one byte a turn.  Texts are not held: the audits then go
back in front of their conversations' turns, sorted the same way, and are applied as the turns pass.

Turns are ordered by ``turn`` (nulls first), equal ones by a digest of role and text.  A null role or text counts as
one blank; an empty role has no initial and cannot be kept.  Rows with a null conv_id are one conversation.  Repeated
rows are duplicates.  Extra columns are ignored; an empty table gives no rows.  Time grows with the turns of one
conversation times the band, that is with the square of its turns if its faults grow along.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from halyard.llm.common import small_batches

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
USER, ASSISTANT, SYSTEM, OTHER, FORCED = range(5)   # a turn's kind; FORCED must be deleted
CUT = 8                                             # added to the kind of a truncated turn
FIRST_BUDGET = 6                                    # cost above the unavoidable that the first band allows
BLOCK = 512                                         # table rows kept at once, at least
INF = 1 << 28

BLANK = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
NAMES = {"u": "user", "a": "assistant"}


class Table:
    """Suffix costs of a conversation inside one band, filled block by block."""

    def __init__(self, kinds: bytes, budget: int):
        self.kinds, n = kinds, len(kinds)
        free = np.frombuffer(kinds, np.uint8) & 7 != FORCED
        cuts = int((np.frombuffer(kinds, np.uint8)[free] >= CUT).sum())
        # a deleted truncated turn costs 1 above what is unavoidable, any other DELETE; a kept s moves one diagonal too
        self.dels = min(int(free.sum()), min(budget, cuts) + max(0, budget - cuts) // DELETE) + 1
        width = self.dels + budget // INSERT + 1
        self.rest = np.concatenate([np.cumsum(free[::-1])[::-1], [0]])  # turns from i on that may stay
        self.ramp = INSERT * np.arange(width, dtype=np.int32)
        even = np.arange(width) % 2 == 0
        self.swap = {True: np.where(even, 0, REROLE).astype(np.int32), False: np.where(even, REROLE, 0).astype(np.int32)}
        self.odd_only = {True: np.where(even, 0, INF).astype(np.int32), False: np.where(even, INF, 0).astype(np.int32)}
        self.step = max(BLOCK, math.isqrt(n))
        k = np.arange(width, dtype=np.int32) - self.dels
        last = np.where(k >= 0, INSERT * k, INF).astype(np.int32), np.full(width, INF, np.int32)
        self.starts = list(range(0, n, self.step)) or [0]
        self.edges = {n: last}
        self.block: list = [last]
        for lo in reversed(self.starts):
            self.block = self.fill(lo)
            self.edges[lo] = self.block[0]

    def fill(self, lo: int) -> list:
        """Rows lo to the end of its block: costs after the choice of ``s``, and costs while a first ``s`` is due."""
        hi = min(lo + self.step, len(self.kinds))
        rows = [self.edges[hi]]
        for i in range(hi - 1, lo - 1, -1):
            after, due = rows[-1]
            kind, cut = self.kinds[i] & 7, self.kinds[i] >= CUT
            if kind == FORCED:
                rows.append((after, due))
                continue
            low = int(self.rest[i]) - self.dels  # characters left at the band's first place
            gone = DELETE - TRUNCATED if cut else DELETE
            cost = np.full(len(after), INF, np.int32)
            cost[:-1] = after[1:] + gone
            if kind in (USER, ASSISTANT):
                np.minimum(cost, after + self.swap[(low % 2 == 0) == (kind == USER)], out=cost)
            else:
                np.minimum(cost, after + REROLE, out=cost)
            cost = np.minimum.accumulate(cost - self.ramp) + self.ramp
            wait = np.full(len(after), INF, np.int32)
            wait[:-1] = due[1:] + gone
            if kind == SYSTEM:
                kept = after[1:] + self.odd_only[low % 2 == 0][:-1]
                kept[:max(0, 2 - low)] = INF
                wait[:-1] = np.minimum(wait[:-1], kept)
            rows.append((cost, wait))
        return rows[::-1]

    def best(self) -> tuple[int, list[tuple[int, bool]]]:
        """The least cost and the alignments that reach it: characters to align, and whether an ``s`` stands first."""
        cost, wait = self.edges[0]
        k = np.arange(len(cost)) + int(self.rest[0]) - self.dels
        plain = np.where((k >= 0) & (k % 2 == 0), cost, INF)
        led = np.where((k >= 2) & (k % 2 == 0), wait, INF)
        least = int(min(plain.min(), led.min()))
        return least, [(int(x), False) for x in k[plain == least]] + [(int(x), True) for x in k[led == least]]

    def audits(self, ends: list[tuple[int, bool]]) -> list[str]:
        """Backtraces each alignment, the ASCII-least edit first wherever several are cheapest."""
        walks = [[k, led, []] for k, led in ends]
        for lo in self.starts:
            if lo:
                self.block = self.fill(lo)
            for walk in walks:
                walk[0], walk[1] = self.walk(lo, walk[0], walk[1], walk[2])
        return ["".join(edits) + "I" * k for k, _, edits in walks]

    def walk(self, lo: int, k: int, led: bool, edits: list[str]) -> tuple[int, bool]:
        for i in range(lo, min(lo + self.step, len(self.kinds))):
            kind = self.kinds[i] & 7
            if kind == FORCED:
                edits.append("D")
                continue
            gone = DELETE - TRUNCATED if self.kinds[i] >= CUT else DELETE
            base, below = k - int(self.rest[i]) + self.dels, k - int(self.rest[i + 1]) + self.dels
            row, after = (x[1 if led else 0] for x in (self.block[i - lo], self.block[i - lo + 1]))
            while True:
                if below < len(after) and row[base] == after[below] + gone:
                    edits.append("D")
                elif led:
                    led = False
                    edits.append("K")
                elif base and k and row[base] == row[base - 1] + INSERT:
                    edits.append("I")
                    k, base, below = k - 1, base - 1, below - 1
                    continue
                else:
                    edits.append("K" if kind == (USER if k % 2 == 0 else ASSISTANT) else "R")
                    k -= 1
                break
        return k, led


def audit(kinds: bytes) -> tuple[int, str]:
    """Cost and audit of a conversation given its turns' kinds."""
    forced = sum(k & 7 == FORCED for k in kinds)
    cuts = sum(k >= CUT and k & 7 != FORCED for k in kinds)
    budget = FIRST_BUDGET
    while True:
        table = Table(kinds, budget)
        cost, ends = table.best()
        if cost <= budget:
            return cost + DELETE * forced + TRUNCATED * cuts, min(table.audits(ends))
        budget = min(cost, 4 * budget)


def targets(edits: str) -> Iterator[str]:
    """The role initials that the repaired conversation spells."""
    n = len(edits) - edits.count("D")
    if n % 2:
        yield "s"
    for i in range(n - n % 2):
        yield "ua"[i % 2]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns])


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1000, weight: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """``rows`` as Arrow batches of at most ``size`` rows and about ``weight`` characters."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(x) for x in row if isinstance(x, str))
        if len(held) >= size or chars >= weight:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def streamed(df: DataFrame, fn: Callable[[Iterator[tuple]], Iterator[tuple]], schema: T.StructType) -> DataFrame:
    """``fn`` over each partition's rows as a stream."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(fn(_rows(batches)), arrow)
    return df.mapInArrow(run, schema)


def conversations(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of each run of equal conv_id."""
    none = object()
    conv, kinds = none, bytearray()

    def done() -> tuple:
        gaps = high - low + 1 - distinct if distinct else 0
        cost, edits = audit(bytes(kinds))
        return conv, gaps, blank, duplicate, truncated, illegal, cost, edits
    for conv_id, turn, initial, fault in rows:
        if conv is none or conv_id != conv:
            if conv is not none:
                yield done()
            conv, kinds, before, low, high = conv_id, bytearray(), None, None, None
            blank = duplicate = truncated = illegal = distinct = 0
        if initial is None:
            continue  # only says that the conversation exists
        if turn is not None and (high is None or turn != high):
            low, high, distinct = turn if low is None else low, turn, distinct + 1
        if before is not None and before + initial not in ("su", "ua", "au"):
            illegal += 1
        before = initial
        blank, duplicate, truncated = blank + (fault == "b"), duplicate + (fault == "d"), truncated + (fault == "t")
        kinds.append(FORCED if fault in ("b", "d") else {"u": USER, "a": ASSISTANT, "s": SYSTEM}.get(initial, OTHER) + CUT * (fault == "t"))
    if conv is not none:
        yield done()


def applied(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conv_id, place, edit, role, text, audit columns): a head with place -1, then the repaired turns in order."""
    conv_id, edits, at, roles, place = None, "", 0, iter(()), 0

    def inserts() -> Iterator[tuple]:
        nonlocal at, place
        while at < len(edits) and edits[at] == "I":
            yield conv_id, place, "I", NAMES[next(roles)], "", None, None, None, None, None, None, None
            at, place = at + 1, place + 1
    for conv, role, text, *head in rows:
        if head[-1] is not None:
            yield from inserts()
            conv_id, edits, at, place = conv, head[-1], 0, 0
            roles = targets(edits)
            yield conv, -1, None, None, None, *head
            continue
        yield from inserts()
        edit, at = edits[at], at + 1
        if edit != "D":
            initial = next(roles)
            yield conv, place, edit, NAMES[initial] if edit == "R" else role, text, None, None, None, None, None, None, None
            place += 1
    yield from inserts()


def repair(turns: DataFrame, gone: Column | None = None) -> DataFrame:
    """The repaired conversations of ``turns`` (conv_id, turn, role, text), in stream order within partitions.

    One row with place -1 for each conversation, with its counts, cost and audit; its turns follow with places from
    0, the edit that made each, role and text.  ``gone``: rows that only say that their conversation exists.
    """
    small_batches(turns.sparkSession)
    gone = F.coalesce(gone, F.lit(False)) if gone is not None else F.lit(False)
    rows = turns.select(turns["conv_id"].alias("conv_id"), gone.alias("gone"), F.when(~gone, turns["turn"]).alias("turn"),
                        F.when(~gone, F.coalesce(turns["role"], F.lit(" "))).alias("role"), F.when(~gone, F.coalesce(turns["text"], F.lit(" "))).alias("text"))
    rows = rows.withColumn("digest", F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    seen = F.row_number().over(Window.partitionBy("conv_id", "digest").orderBy(F.col("turn").asc_nulls_first())) > 1
    fault = F.when(~F.col("text").rlike(BLANK), "b").when(~F.col("text").rlike(ENDED), "t").otherwise("-")
    marked = rows.select("conv_id", "gone", "turn", "digest", F.substring("role", 1, 1).alias("initial"), fault.alias("fault")) \
        .repartition("conv_id") \
        .withColumn("fault", F.when((F.col("fault") != "b") & seen, "d").otherwise(F.col("fault"))) \
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "digest") \
        .select("conv_id", "turn", "initial", "fault")
    id_field = T.StructField("conv_id", turns.schema["conv_id"].dataType)
    columns = [T.StructField(c, T.LongType()) for c in COUNTS] + [T.StructField("audit", T.StringType())]
    heads = streamed(marked, conversations, T.StructType([id_field, *columns]))
    both = rows.where("not gone").select("conv_id", "turn", "digest", "role", "text", F.lit(1).alias("late")) \
        .unionByName(heads.withColumn("late", F.lit(0)), allowMissingColumns=True)
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "late", F.col("turn").asc_nulls_first(), "digest")
    made = T.StructType([id_field, T.StructField("place", T.LongType()), T.StructField("edit", T.StringType()),
                         T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), *columns])
    return streamed(ordered.select("conv_id", "role", "text", *COUNTS, "audit"), applied, made)
