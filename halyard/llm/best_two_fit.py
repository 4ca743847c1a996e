"""Packing of tokenised documents into sequences by best-two-fit.

Documents longer than a sequence are cut into pieces of its capacity, the first piece being the shorter one.  A
sequence is filled greedily, the largest fitting piece first; if it then holds more than one piece and is not full, its
smallest piece is replaced by the two unpacked pieces that fit the gap it leaves most tightly, if together they are
larger.  The replaced piece goes back to the unpacked ones.

Pieces of equal length are interchangeable, so the packing is worked out on the counts of the lengths, at most
``capacity`` numbers, whatever the number of documents: a pattern of lengths is repeated as often as the filling one
sequence after the other would repeat it.  The plan says which ranks among the pieces of a length go where; its size
is bounded by the capacity (some hundreds to a few thousand entries at 1,024).  Spark encodes, counts and ranks the
pieces (a written number within task and length, plus the counts of earlier tasks) and looks every one up in the plan.

Null texts count as empty: a piece of the end id alone, or no piece at all without an end id.  Null and repeated
doc_ids are packed like others.  Only doc_id and text are read; an empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from halyard.llm.common import small_batches
from halyard.llm.pieces import AGREED, byte_letters, revive
from halyard.session import cut_lineage

PIECES = "task int, nth long, doc_id long, piece int, start long, length int, ids binary"


def merge_ranks(spec: str) -> dict[bytes, int] | None:
    """Ranks by which merging the lowest pair first gives the file's ids, if it is a byte-level BPE in which every merge
    makes the next id; else None."""
    model = json.loads(spec)["model"]
    back = {c: b for b, c in byte_letters().items()}
    vocabulary = {t: i for t, i in model["vocab"].items() if all(c in back for c in t)}
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    first = len(back)
    if model.get("type") != "BPE" or any(vocabulary.get(c, first) >= first for c in back) or any(vocabulary.get(a + b) != first + i for i, (a, b) in enumerate(pairs)):
        return None
    return {bytes(back[c] for c in t): i for t, i in vocabulary.items() if i < first + len(pairs)}


class ByteEncoder:
    """The library's ids for byte-level vocabularies, by the faster merging of another library where it is proved equal.

    Texts with a special token's string, with characters that the two may class differently or with runs of white space
    too long for the split pattern are encoded by the vocabulary's own library.
    """

    def __init__(self, spec: str, pattern: str):
        self.state = spec, pattern
        self.library, ranks = Tokenizer.from_str(spec), merge_ranks(spec)
        self.specials = [t["content"] for t in json.loads(spec).get("added_tokens", [])]
        self.merger = ranks and tiktoken.Encoding("proved", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __reduce__(self):
        return revive, (ByteEncoder, *self.state)

    def encode(self, text: str) -> np.ndarray:
        """Ids (unsigned 32-bit) of the whole text."""
        if self.merger and not AGREED.search(text) and not any(s in text for s in self.specials):
            try:
                return self.merger.encode_to_numpy(text, disallowed_special=())
            except ValueError:  # the pattern ran out of stack
                pass
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)


def cuts(length: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document."""
    at = length % capacity
    if at:
        yield 0, at
    for start in range(at, length, capacity):
        yield start, capacity


def patterns(counts: dict[int, int], capacity: int) -> Iterator[tuple[dict[int, int], int]]:
    """(copies of each length in a sequence, number of such sequences), in the order in which they are filled."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    while True:
        sizes = np.flatnonzero(left)
        if not len(sizes):
            return
        filled: dict[int, int] = {}
        gap = capacity
        while (at := int(np.searchsorted(sizes, gap, "right"))) > 0:  # the largest lengths that still fit
            size = int(sizes[at - 1])
            n = min(int(left[size]), gap // size)
            filled[size], gap = n, gap - n * size
            sizes = sizes[:at - 1]
        used, final = filled, filled
        smallest = min(filled)
        if gap and sum(filled.values()) > 1 and (two := best_two(left, filled, smallest, gap + smallest)):
            used, final = dict(filled), dict(filled)
            final[smallest] -= 1
            for size in two:
                used[size] = used.get(size, 0) + 1
                final[size] = final.get(size, 0) + 1
            final = {size: n for size, n in final.items() if n}
        # the filling repeats as long as everything it looked at is still there
        times = min((int(left[size]) - used[size]) // n for size, n in final.items()) + 1
        for size, n in final.items():
            left[size] -= n * times
        yield final, times


def best_two(left: np.ndarray, filled: dict[int, int], smallest: int, gap: int) -> tuple[int, int] | None:
    """The two unpacked lengths of greatest sum in (smallest, gap]; of equal sums the pair with the longest piece."""
    free = left[:gap].copy()
    for size, n in filled.items():
        if size < gap:
            free[size] -= n
    sizes = np.flatnonzero(free > 0)
    if not len(sizes):
        return None
    at = np.searchsorted(sizes, gap - sizes, "right") - 1      # the longest partner of each
    at = np.where(at >= 0, at, len(sizes))
    partner = np.append(sizes, -capacity_of(left))[at]
    alone = (partner == sizes) & (free[sizes] < 2)             # no second piece of that length: the next shorter one
    partner = np.where(alone, np.append(sizes, -capacity_of(left))[np.where(at > 0, at - 1, len(sizes))], partner)
    total = sizes + partner
    best = int(np.flatnonzero(total == total.max())[-1])
    if total[best] <= smallest:
        return None
    return int(sizes[best]), int(partner[best])


def capacity_of(left: np.ndarray) -> int:
    return len(left) - 1


def plan(counts: dict[int, int], capacity: int) -> pd.DataFrame:
    """Rows (length, first, copies, sequence, offset): from rank ``first`` on, ``copies`` pieces a sequence, one after
    the other from ``offset``; sequences numbered from ``sequence``."""
    rows, given, sequence = [], dict.fromkeys(counts, 0), 0
    for pattern, times in patterns(counts, capacity):
        offset = 0
        for length in sorted(pattern, reverse=True):
            rows.append((length, given[length], pattern[length], sequence, offset))
            given[length] += pattern[length] * times
            offset += pattern[length] * length
        sequence += times
    return pd.DataFrame(rows, columns=["length", "first", "copies", "sequence", "offset"]).sort_values(["length", "first"], ignore_index=True)


def encoded_pieces(spark: SparkSession, docs: DataFrame, spec: str, pattern: str, end_id: int | None, capacity: int) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text) with their ids (2 bytes each if the vocabulary allows, else 4), written once."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(ByteEncoder(spec, pattern))
    tail, narrow = np.array([] if end_id is None else [end_id], np.uint32), id_width(spec)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, seen = shared.value, TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64).tolist()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.concatenate([encoder.encode(text or ""), tail]).astype(f"<u{narrow}").tobytes()
                for piece, (start, length) in enumerate(cuts(len(ids) // narrow, capacity)):
                    rows.append((task, seen[length], doc_id, piece, start, length, ids[start * narrow:(start + length) * narrow]))
                    seen[length] += 1
            if rows:
                types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[c.split()[0] for c in PIECES.split(", ")])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return cut_lineage(rows.mapInArrow(encode, PIECES), "pieces")


def id_width(spec: str) -> int:
    return 2 if Tokenizer.from_str(spec).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def placed(spark: SparkSession, pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` with sequence_id and offset.  Pass only the columns that are needed: rows move once, by task and length."""
    per_task = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    entries = plan(counts, capacity)
    low = (entries["length"].to_numpy(np.int64) << 40) + entries["first"].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast((low, *(entries[c].to_numpy(np.int64) for c in ("first", "copies", "sequence", "offset"))))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # one row a task
    earlier = per_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))

    @F.pandas_udf("sequence_id long, offset long")
    def look_up(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        lows, first, copies, sequence, offset = shared.value
        size, r = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        at = np.searchsorted(lows, (size << 40) + r, "right") - 1
        turn, copy = np.divmod(r - first[at], copies[at])
        return pd.DataFrame({"sequence_id": sequence[at] + turn, "offset": offset[at] + copy * size})
    ranked = pieces.join(earlier, ["task", "length"])
    own = [c for c in pieces.columns if c not in ("task", "nth")]
    return ranked.select(*own, look_up("length", F.col("nth") + F.col("_before")).alias("_p")).select(*own, "_p.*")


def sequences(spark: SparkSession, pieces: DataFrame, capacity: int) -> DataFrame:
    """The packed sequences: sequence_id, doc_ids, offsets, ids; at most ``capacity`` pieces meet in a row."""
    rows = placed(spark, pieces, capacity)
    return rows.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p")) \
        .select("sequence_id", F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("offsets"),
                F.expr("aggregate(p, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids"))
