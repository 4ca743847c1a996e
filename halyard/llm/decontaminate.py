"""Benchmark decontamination by q-gram lemma filtering.

Texts are compared as lower-cased letters and digits, every run of other characters one blank.  A benchmark
item of at most 200 such characters is looked for whole; of a longer one every 200 consecutive characters are,
from whatever offset.  A window of m characters may occur with e = 10 % of m edits.  By the q-gram lemma such
an occurrence shares at least T = m + 1 - q (e + 1) of the window's q-grams (q = 8), all on diagonals (place
in the text minus place in the item) no more than e apart.  Shared q-grams are counted in diagonal bands
twice that wide that overlap by half, so one band has them all; where T or more places of a band fit one
window, the windows that hold them are aligned, inside the region that they and the band span, by a
bit-parallel semi-global alignment, and occurrences of at most e edits stay.  The next window's distance
differs by at most 1, so windows that cannot reach the budget are skipped without an alignment.

Items are indexed in patterns: a window every 200 characters with the up to 199 characters after it, so each
window lies in one pattern and a q-gram is indexed at most twice.

Where T would fall below 1 the budget is lowered, down to exact occurrence.  Items of fewer than 8 characters have no
q-gram: they match exactly, as whole words.  Null texts and items match nothing; an empty benchmark matches nothing.  Equal items are all
reported; repeated documents are judged row by row.  Long texts are scanned in pieces that overlap by more
than an occurrence, and pieces in which very many q-grams are shared (runs of one character) are halved first, so
that the places held at once are bounded.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halyard.llm.common import small_batches
from halyard.llm.pieces import give_up
from halyard.session import cut_lineage

Q = 8                 # characters of a q-gram; qgrams() is written for it
EDITS = 0.10          # edit budget as a share of the pattern
LONGEST = 200         # characters of a window
BLOCK = 20_000        # patterns of a block: bounds what is broadcast at once (about 100 MB)
PIECE = 1 << 20       # characters of a text scanned at once
SHARED = 1 << 18      # pairs of places, in the text and in patterns, from which a piece is halved
TABLE_BITS = 22

HITS = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("edits", T.IntegerType()),
                                 T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))

WORD = re.compile("[^ ]+")

_K1, _K2, _K4 = (np.uint64(pow(0x9E3779B97F4A7C15, n, 1 << 64)) for n in (1, 2, 4))
_table: np.ndarray | None = None


def _letters_and_digits() -> np.ndarray:
    global _table
    if _table is None:
        t = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalnum():
                low = ch.lower()
                t[c] = ord(low) if len(low) == 1 else c
        _table = t
    return _table


def normal(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The compared characters and where each stands in ``text``."""
    a = _letters_and_digits()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    keep = a != 32
    keep[1:] |= a[:-1] != 32  # the first blank of a run
    at = np.flatnonzero(keep)
    return a[at], at


def _string(a: np.ndarray) -> str:
    return a.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def qgrams(a: np.ndarray) -> np.ndarray:
    if len(a) < Q:
        return np.empty(0, np.uint64)
    w = a.astype(np.uint64)
    two = w[:-1] * _K1 + w[1:]
    four = two[:-2] * _K2 + two[2:]
    h = four[:-4] * _K4 + four[4:]  # Q characters, by doubling
    return (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)


def budget(m: int) -> int:
    """The largest edit budget up to EDITS with a positive q-gram threshold."""
    return max(0, min(int(EDITS * m), (m + 1 - Q - 1) // Q))


class Block:
    """The patterns of some benchmark items and the index of their q-grams."""

    def __init__(self, items: list[tuple[int, np.ndarray, np.ndarray]]):
        self.short: dict[str, list[int]] = {}
        for i, a, _ in items:
            if len(a) < Q:
                self.short.setdefault(_string(a), []).append(i)
        self.short_words = sorted({s.count(" ") + 1 for s in self.short})
        items = [x for x in items if len(x[1]) >= Q]
        whole = [np.concatenate([a, after]) for _, a, after in items]
        self.item = [i for i, _, _ in items]
        self.text = [_string(a) for a in whole]
        self.window = np.array([len(a) for _, a, _ in items], np.int64)
        self.edits = np.array([budget(m) for m in self.window], np.int64)
        self.least = self.window + 1 - Q * (self.edits + 1)
        grams = [qgrams(a) for a in whole]
        gram = np.concatenate([*grams, np.empty(0, np.uint64)])
        order = np.argsort(gram, kind="stable")
        self.gram, self.first, self.count = np.unique(gram[order], return_index=True, return_counts=True)
        self.pattern = np.repeat(np.arange(len(items)), [len(g) for g in grams])[order]
        self.place = np.concatenate([*(np.arange(len(g)) for g in grams), np.empty(0, np.int64)])[order].astype(np.int64)
        self.seen = np.zeros(1 << TABLE_BITS, bool)
        self.seen[self.gram >> np.uint64(64 - TABLE_BITS)] = True

    def shared(self, a: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Places in ``a`` of known q-grams, their entries, and the number of pairs of places."""
        h = qgrams(a)
        at = np.flatnonzero(self.seen[h >> np.uint64(64 - TABLE_BITS)])
        entry = np.minimum(np.searchsorted(self.gram, h[at]), len(self.gram) - 1)
        known = self.gram[entry] == h[at]
        at, entry = at[known], entry[known]
        return at, entry, int(self.count[entry].sum())

    def words(self, whole: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, first, last) of the short items that stand in a text as whole words."""
        text = _string(whole)
        bounds = [m.span() for m in WORD.finditer(text)]
        for n in self.short_words:
            for i in range(len(bounds) - n + 1):
                low, high = bounds[i][0], bounds[i + n - 1][1]
                for item in self.short.get(text[low:high], ()) if high - low < Q else ():
                    yield item, int(at[low]), int(at[high - 1])

    def regions(self, a: np.ndarray, at: np.ndarray, entry: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(pattern, first, last, from, to): windows of the pattern, by where they start, that share their threshold
        of q-grams with one diagonal band, and the part of ``a`` that they and the band span."""
        if not len(at):
            return
        low, n = self.first[entry], self.count[entry]
        which = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        pattern, diagonal = self.pattern[which], np.repeat(at, n) - self.place[which]
        half = self.edits[pattern] + 1
        band = diagonal // half
        # each q-gram counts in the band that starts at its half and in the one before
        key = np.concatenate([pattern, pattern]) * (1 << 32) + np.concatenate([band, band - 1]) + (1 << 31)
        place = np.tile(self.place[which], 2)
        keys, count = np.unique(key, return_counts=True)
        dense = np.isin(key, keys[count >= self.least[keys >> 32]])
        key, place = key[dense], place[dense]
        order = np.lexsort((place, key))
        key, place = key[order], place[order]
        new = np.ones(len(key), bool)  # a q-gram of the pattern counts once
        new[1:] = (key[1:] != key[:-1]) | (place[1:] != place[:-1])
        key, place = key[new], place[new]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else []
        for i, j in zip(starts, [*starts[1:], len(key)]):
            p, b = int(key[i]) >> 32, (int(key[i]) & ((1 << 32) - 1)) - (1 << 31)
            e, m, least = int(self.edits[p]), int(self.window[p]), int(self.least[p])
            first, last = place[i + least - 1:j] - (m - Q), place[i:max(i, j - least + 1)]  # windows that hold ``least`` in a row
            first, last = np.maximum(first, 0), np.minimum(last, len(self.text[p]) - m)
            fits = first <= last
            first, last = first[fits].tolist(), last[fits].tolist()
            while first:  # windows that overlap or touch are one run
                n = 1
                while n < len(first) and first[n] <= last[n - 1] + 1:
                    n += 1
                u, v = first[0], last[n - 1]
                yield p, u, v, max(0, b * (e + 1) + u - e), min(len(a), (b + 2) * (e + 1) + v + m + e)
                first, last = first[n:], last[n:]


def best_end(pattern: str, region: str) -> tuple[int, int]:
    """(edits, end) of the pattern's best occurrence in the region; the first end of equals."""
    m = len(pattern)
    exact = region.find(pattern)
    if exact >= 0:
        return 0, exact + m
    where: dict = {}
    for i, x in enumerate(pattern):
        where[x] = where.get(x, 0) | (1 << i)
    full, last = (1 << m) - 1, m - 1
    up, down, edits = full, 0, m
    best, end = m, 0
    for j, x in enumerate(region, 1):
        eq = where.get(x, 0)
        cross = eq | down
        diagonal = (((eq & up) + up) ^ up) | eq | down
        right, left = (down | ~(diagonal | up)) & full, up & diagonal
        edits += (right >> last & 1) - (left >> last & 1)
        right, left = (right << 1) & full, (left << 1) & full  # an occurrence may start anywhere
        up, down = (left | ~(cross | right)) & full, right & cross
        if edits < best:
            best, end = edits, j
    return best, end


def occurrences(block: Block, p: int, first: int, last: int, region: str) -> tuple[int, int, int] | None:
    """(fewest edits, from, to) in the region of the pattern's windows that start at first to last, or None.

    A window's distance is at most 1 from that of the window before: a distance of d rules out the next
    d - e - 1 windows for a budget of e.
    """
    pattern, m, e = block.text[p], int(block.window[p]), int(block.edits[p])
    known: dict[int, tuple[int, int]] = {}

    def at(s: int) -> tuple[int, int]:
        if s not in known:
            known[s] = best_end(pattern[s:s + m], region)
        return known[s]
    while first <= last and at(first)[0] > e:
        first += at(first)[0] - e
    if first > last:
        return None
    while at(last)[0] > e:
        last -= at(last)[0] - e
    best, s = at(first)[0], first
    while best and s <= last:
        best = min(best, at(s)[0])
        s += at(s)[0] - best + 1
    low, high = len(region), 0
    for s in {first, last}:
        end = at(s)[1]
        _, back = best_end(pattern[s:s + m][::-1], region[:end][::-1])
        low, high = min(low, end - max(back, 1)), max(high, end)
    return best, low, high


def scan(text: str | None, block: Block) -> list[tuple[int, int, int, int]]:
    """Per item found: (item_id, fewest edits of a window, first and last character of all its occurrences)."""
    if not text or not len(block.gram) and not block.short:
        return []
    whole, at = normal(text)
    found: dict[int, tuple[int, int, int]] = {}
    for item, begin, end in block.words(whole, at) if block.short else ():
        was = found.get(item, (0, begin, end))
        found[item] = (0, min(was[1], begin), max(was[2], end))
    overlap = 4 * LONGEST
    pieces = [(start, PIECE) for start in range(0, len(whole), PIECE)][::-1] if len(block.gram) else []
    while pieces:
        start, size = pieces.pop()
        a = whole[start:start + size + overlap]
        places, entry, pairs = block.shared(a)
        if pairs > SHARED and size > overlap:
            half = size // 2
            pieces += [(start + half, size - half), (start, half)]
            continue
        done: dict[tuple[int, int, int], int] = {}  # pattern and windows -> end of the last occurrence
        for p, first, last, low, high in block.regions(a, places, entry):
            if done.get((p, first, last), -1) >= high - int(block.window[p]) // 2:
                continue
            got = occurrences(block, p, first, last, _string(a[low:high]))
            if got is None:
                continue
            edits, begin, end = got
            done[p, first, last] = low + end
            begin, end = int(at[start + low + begin]), int(at[start + low + end - 1])
            item = block.item[p]
            was = found.get(item, (edits, begin, end))
            found[item] = (min(was[0], edits), min(was[1], begin), max(was[2], end))
    return [(item, *v) for item, v in sorted(found.items())]


def patterns(item_id: int, text: str | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(item_id, window, what follows it up to the last character before the next pattern's window ends)."""
    a = normal(text)[0] if text else np.empty(0, np.uint32)
    a = a[1:] if len(a) and a[0] == 32 else a
    a = a[:-1] if len(a) and a[-1] == 32 else a
    if not len(a):
        return
    for at in range(0, max(1, len(a) - LONGEST + 1), LONGEST):
        yield item_id, a[at:at + LONGEST], a[at + LONGEST:at + 2 * LONGEST - 1]


def blocks(benchmark: DataFrame) -> Iterator[Block]:
    """The benchmark (item_id, text) in blocks of at most BLOCK patterns, read one partition at a time."""
    held: list = []
    for row in benchmark.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        for p in patterns(*row):
            held.append(p)
            if len(held) == BLOCK:
                yield Block(held)
                held = []
    if held:
        yield Block(held)


def hits(spark: SparkSession, text: Column, block: Block) -> Column:
    """Array of (item_id, edits, first, last): the block's items found in each text."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(block)

    @F.pandas_udf(HITS)
    def run(texts: pd.Series) -> pd.Series:
        give_up()
        return pd.Series([scan(t, shared.value) for t in texts], dtype=object)
    return run(text)


def find(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, edits, first, last), one row for each document and item of which a window occurs.

    One pass over the documents for each block of the benchmark.
    """
    rows = None
    for block in blocks(benchmark):
        part = docs.select("doc_id", F.explode(hits(spark, F.col("text"), block)).alias("h")).select("doc_id", "h.*")
        rows = part if rows is None else rows.unionByName(part)
    if rows is None:
        return spark.createDataFrame([], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id long, edits int, first long, last long")
    return rows


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those in which a benchmark item is found."""
    for n, block in enumerate(blocks(benchmark)):
        docs = cut_lineage(docs, "clean") if n else docs
        docs = docs.where(F.size(hits(spark, F.col("text"), block)) == 0)
    return docs
