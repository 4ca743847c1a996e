"""Near-duplicate classes by Order MinHash, verified by banded alignment.

A text's words (lower-cased, split at white space) give 3-word k-mers, each labelled with its occurrence
number.  For each of 48 hash functions the sketch takes the 2 labelled k-mers with the smallest hashes and
keeps them in text order, so two texts agree in an entry if they share both k-mers in the same order: a
measure that follows edit similarity, not only the set overlap.  Length and number are set for the bound on
edits: with a fifth of the words replaced at random about half of the 3-word k-mers stay (Jaccard 0.34), an
entry agrees with chance 0.12 and none of 48 with about 0.002.  Short texts have too few k-mers for that: texts of up
to 14 words have besides an entry for every way to delete up to a fifth of their words, and two such texts within
the bound always agree in one.

Texts that agree in an entry meet in a bucket.  Every member is paired with the bucket's smallest key, so a
bucket of n texts gives n - 1 candidates, however large it is: one shuffle of (entry, key) pairs, sorted, and the first
key of a run is its leader.  Each candidate is verified over the whole texts: the word edit distance, by a bit-parallel
alignment inside the band of diagonals that the budget allows, must be at most a fifth of the longer text.  Members that
the leader fails, as in a bucket of a common passage, meet again without it: what the leader lacks of each is sketched
(short texts: all their deletions), members that agree there form buckets with a leader of their own, and so on until
no new pair is left.  A text shows each of these values once, however many leaders of one passage failed it.  Long texts
that only share what an unrelated leader has too are not compared with each other.
Connected components of the verified links are the classes; a pair that is in one class already is not verified again.

Words are compared by 16-bit codes of their hashes: two unequal words pass as equal with chance 1 in 65,536.  Exact copies
share a 64-bit key of their text and are sketched once per row but compared once; only texts of a candidate are moved.
Null texts and texts without a word stand alone.  Texts of fewer than 3 words have one k-mer, all their words.
Repeated rows fall into one class; an empty table gives an empty result.  A null doc_id is allowed.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halyard.llm.common import map_text, packed, small_batches, unpacked
from halyard.llm.pieces import give_up
from halyard.session import cut_lineage

WORDS = 3            # words of a k-mer
SKETCHES = 48        # hash functions
LEFT_SKETCHES = 16   # those of what a leader lacks
ORDERED = 2          # k-mers that each one keeps in text order
MIN_SIMILARITY = 0.8
SHORT = 14           # words of a text up to which its deletions are indexed
CHUNK = 1 << 13      # k-mers of a text handled at once
MASKS = 1 << 25      # bytes of position masks that an alignment holds
FEW = 500_000        # rows of keys that may be broadcast: at most 12 MB

SCHEMA = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("tokens", T.BinaryType()),
                       T.StructField("sketch", T.ArrayType(T.LongType()))])

JUDGED = T.StructType([T.StructField("ok", T.BooleanType()), T.StructField("left", T.ArrayType(T.LongType()))])

_SEEDS = np.random.default_rng(11).integers(1, 1 << 63, SKETCHES, dtype=np.uint64)[:, None]
_POWERS = np.cumprod(np.full(1 << 12, 0x100000001B3, np.uint64))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(29))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word of the lower-cased text."""
    a = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    space = (a <= 32) & ((a == 32) | ((a >= 9) & (a <= 13)))
    at = np.flatnonzero(~space)
    if not len(at):
        return np.empty(0, np.uint64)
    first = np.concatenate([[True], np.diff(at) != 1])
    starts = np.flatnonzero(first)
    inside = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
    return _mix(np.add.reduceat((a[at].astype(np.uint64) + np.uint64(7)) * _POWERS[inside & 0xFFF], starts))


def kmers(words: np.ndarray) -> np.ndarray:
    """Hashes of the occurrence-labelled k-mers in text order."""
    k = min(WORDS, len(words))
    n = len(words) - k + 1
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[i:i + n]
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.concatenate([[True], s[1:] != s[:-1]])
    if not new.all():
        starts = np.flatnonzero(new)
        label = np.empty(n, np.uint64)
        label[order] = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
        h = h + label * np.uint64(0xD6E8FEB86659FD93)
    return _mix(h)


def sketch(words: np.ndarray) -> list[int]:
    return smallest(kmers(words), SKETCHES)


def smallest(h: np.ndarray, n: int) -> list[int]:
    """One signed 64-bit value for each of n hash functions: its smallest k-mers, combined in text order."""
    keep = min(ORDERED, len(h))
    place = np.empty((n, 0), np.int64)
    value = np.empty((n, 0), np.uint64)
    for at in range(0, len(h), CHUNK):  # the smallest so far against the next chunk's
        v = np.concatenate([value, _mix(h[None, at:at + CHUNK] ^ _SEEDS[:n])], axis=1)
        p = np.concatenate([place, np.broadcast_to(np.arange(at, min(len(h), at + CHUNK)), (n, v.shape[1] - value.shape[1]))], axis=1)
        pick = np.argpartition(v, min(keep, v.shape[1]) - 1, axis=1)[:, :keep]
        place, value = np.take_along_axis(p, pick, 1), np.take_along_axis(v, pick, 1)
    out = _SEEDS[:n, 0].copy()  # entries of different functions differ
    for i in np.sort(place, axis=1).T:
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i])
    return out.view(np.int64).tolist()


@cache
def _kept(n: int, gone: int) -> np.ndarray:
    """Places that stay when ``gone`` of ``n`` are deleted, one row for each way."""
    return np.array(list(combinations(range(n), n - gone)), np.int64)


def deletions(words: np.ndarray) -> list[int]:
    """An entry for every way to delete at most a fifth of a short text's words."""
    out = []
    for gone in range(int(len(words) * (1 - MIN_SIMILARITY) + 1e-9) + 1):
        h = np.full(1, len(words) - gone, np.uint64)
        for i in _kept(len(words), gone).T:
            h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + words[i])
        out += h.view(np.int64).tolist()
    return out


def entries(words: np.ndarray) -> list[int]:
    """The bucket values of a text with a word."""
    return sketch(words) + (deletions(words) if len(words) <= SHORT else [])


def _sketch_texts(texts: list) -> pd.DataFrame:
    give_up()
    rows = []
    for t in texts:
        w = word_hashes(t) if t else np.empty(0, np.uint64)
        rows.append((len(w), (w >> np.uint64(48)).astype("<u2").tobytes(), entries(w)) if len(w) else (0, b"", []))
    return pd.DataFrame(rows, columns=SCHEMA.names)


def banded_distance(a: list, b: list, budget: int) -> int:
    """Edit distance of two sequences if at most ``budget``, else a number above it.

    Bit-parallel dynamic programming on the band of 2 * budget + 1 diagonals: bit t of a row's vectors stands
    for column i - budget + t, so the vectors slide along the main diagonal with the rows.
    """
    if len(a) < len(b):
        a, b = b, a
    n, m = len(a), len(b)
    if n - m > budget:
        return budget + 1
    if budget >= m:  # the band covers everything: one vector of all columns, with the same recurrence
        budget = max(n, 1)
    mask = _masks(a)
    band = (1 << (2 * budget + 1)) - 1
    up, down = (band >> budget) << budget, 0   # vertical steps of +1 and -1
    top, distance = 2 * budget, budget         # follows the band's last diagonal, then the last column
    if budget > n:
        top, distance = budget + n, n
    for i in range(m):
        x = mask(b[i])
        eq = ((x << budget) >> i) & band
        diagonal = ((((eq & up) + up) ^ up) | eq | down) & band
        right, left = (down | ~(diagonal | up)) & band, diagonal & up
        if i + budget < n:
            distance += not diagonal >> top & 1
        else:
            t = n - i - 1 + budget
            distance += (right >> t & 1) - (left >> t & 1)
        slid = diagonal >> 1
        up, down = (left | ~(slid | right)) & band, slid & right
    return distance


def _masks(a: list):
    """The positions of a value in ``a`` as the bits of a number; the frequent values' numbers are held, within MASKS."""
    places: dict = {}
    for i, x in enumerate(a):
        places.setdefault(x, []).append(i)
    room = MASKS // (len(a) // 8 + 32)
    often = places if len(places) <= room else sorted(places, key=lambda x: -len(places[x]))[:room]

    def mask(x) -> int:
        at = places.get(x)
        if not at:
            return 0
        if len(at) < 8:
            return sum(1 << i for i in at)
        bits = np.zeros(at[-1] + 1, bool)
        bits[at] = True
        return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
    held = {x: mask(x) for x in often}
    return lambda x: held[x] if x in held else mask(x)


def similar(a: bytes, b: bytes) -> bool:
    """Whether the word sequences (16-bit tokens) are within a fifth of the longer one's length in edits."""
    x, y = np.frombuffer(a, "<u2"), np.frombuffer(b, "<u2")
    longer = max(len(x), len(y))
    budget = int(longer * (1 - MIN_SIMILARITY) + 1e-9)
    if abs(len(x) - len(y)) > budget:
        return False
    # words of one text without a partner in the other each cost an edit
    sx, sy = np.unique(x, return_counts=True), np.unique(y, return_counts=True)
    _, i, j = np.intersect1d(sx[0], sy[0], assume_unique=True, return_indices=True)
    if longer - int(np.minimum(sx[1][i], sy[1][j]).sum()) > budget:
        return False
    return banded_distance(x.tolist(), y.tolist(), budget) <= budget


def left_over(a: bytes, leader: bytes) -> list[int]:
    """Bucket values of what its leader lacks of ``a``: its other k-mers, and all deletions of a short text."""
    words, its = (_mix(np.frombuffer(x, "<u2").astype(np.uint64) + np.uint64(1)) for x in (a, leader))
    h = kmers(words)
    h = h[~np.isin(h, kmers(its))]
    return (smallest(h, LEFT_SKETCHES) if len(h) else []) + (deletions(words) if len(words) <= SHORT else [])


def sketched(spark: SparkSession, docs: DataFrame, text: str = "text") -> DataFrame:
    """One row a document: doc_id, key (null without a word), n, tokens, sketch; written once."""
    small_batches(spark)
    t = docs.select(F.col("doc_id").alias("doc_id"), F.col(text).alias("_t"))
    out = t.select("doc_id", F.xxhash64("_t").alias("key"), map_text(F.col("_t"), _sketch_texts, SCHEMA).alias("s"))
    out = out.select("doc_id", F.when(F.col("s.n") > 0, F.col("key")).alias("key"), "s.*")
    return cut_lineage(out, "omh")


def stars(rows: DataFrame, *within: str) -> DataFrame:
    """Distinct (leader, key) pairs of ``rows`` (key, value): every bucket member with the bucket's smallest key.

    Buckets are runs of equal value (and equal ``within``) in one sorted shuffle; nothing of a run is held.
    """
    run = Window.partitionBy(*within, "value").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.select("key", F.first("key").over(run).alias("first")).where("first <> key") \
        .select(F.col("first").alias("leader"), "key").distinct()


def candidates(rows: DataFrame) -> DataFrame:
    return stars(rows.where(F.col("key").isNotNull()).select("key", F.explode("sketch").alias("value")))


def few(keys: DataFrame, rows: int | None = None) -> DataFrame:
    """A written table of keys, broadcast if it has FEW rows at most; otherwise a join shuffles both sides."""
    return F.broadcast(keys) if (keys.count() if rows is None else rows) <= FEW else keys


def across(pairs: DataFrame, seen: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs not verified yet whose two texts are not in one class either."""
    a, b = (labels.select(F.col("node").alias(c), F.col("label").alias(f"_{c}")) for c in ("leader", "key"))
    return pairs.join(seen, ["leader", "key"], "left_anti").join(a, "leader").join(b, "key").where("_leader <> _key").select("leader", "key")


def classes(rows: DataFrame) -> DataFrame:
    """(node, label) of every text that met another: the smallest key of its class.

    First every text is verified against the smallest of its leaders, then all pairs that are not in one class by
    then, then the members that a leader failed and their new leaders, round by round until no such pair is left.
    """
    pairs = cut_lineage(candidates(rows), "pairs")
    met = cut_lineage(pairs.select("key").unionByName(pairs.select(F.col("leader").alias("key"))).distinct(), "met")
    # the texts of candidates only, once each; later rounds pair the same texts anew
    tokens = cut_lineage(rows.select("key", "tokens").join(few(met), "key").groupBy("key").agg(F.first("tokens").alias("tokens")), "tokens")

    @F.pandas_udf(JUDGED)
    def verify(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        give_up()
        ok = [similar(x, y) for x, y in zip(a, b)]
        return pd.DataFrame({"ok": ok, "left": [[] if k else left_over(x, y) for k, x, y in zip(ok, a, b)]}, columns=JUDGED.names)

    labels = tokens.select(F.col("key").alias("node"), F.col("key").alias("label"))
    now = cut_lineage(pairs.groupBy("key").agg(F.min("leader").alias("leader")).select("leader", "key"), "first")
    rest, seen, failed = pairs, None, None
    while True:
        n = now.count()
        leaders = tokens.select(F.col("key").alias("leader"), F.col("tokens").alias("b")).join(few(now.select("leader").distinct(), n), "leader")
        both = tokens.withColumnRenamed("tokens", "a").join(few(now, n), "key").join(leaders, "leader")
        judged = cut_lineage(both.select("leader", "key", verify("a", "b").alias("v")), "judged")
        done, lost = judged.select("leader", "key"), judged.where("not v.ok").select("leader", "key", F.col("v.left").alias("left"))
        seen = done if seen is None else seen.unionByName(done)
        failed = lost if failed is None else failed.unionByName(lost)
        ends = [labels.select(F.col("node").alias(c), F.col("label").alias(f"_{c}")) for c in ("leader", "key")]
        merged = components(judged.where("v.ok").select("leader", "key").join(ends[0], "leader").join(ends[1], "key")
                            .select(F.col("_leader").alias("u"), F.col("_key").alias("v")))
        labels = cut_lineage(labels.join(merged.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left")
                             .select("node", F.coalesce("to", "label").alias("label")), "classes")
        if rest is not None:  # the other pairs of the first buckets, before what failed meets again
            now, rest = cut_lineage(across(rest, seen, labels), "again"), None
            if not now.isEmpty():
                continue
        now, failed = cut_lineage(across(meet_again(failed), seen, labels), "again"), None
        if now.isEmpty():
            return labels


def meet_again(failed: DataFrame) -> DataFrame:
    """``stars`` of the members that a leader failed, by the values of what it lacks of each (leader, key, left).

    Leaders of one passage leave the same of a text, so each text shows a value once, however many leaders failed it (only
    its own lists are gathered, one a leader).  Values that no other text shows go; for the others the leaders are looked up.
    """
    own = failed.groupBy("key").agg(F.array_distinct(F.flatten(F.collect_list("left"))).alias("left")) \
        .select("key", F.explode("left").alias("value"))
    run = Window.partitionBy("value").orderBy("key")
    shared = own.select("key", "value", F.lag("key").over(run).alias("before"), F.lead("key").over(run).alias("after")) \
        .where("before is not null or after is not null").select("key", "value")
    return stars(failed.withColumnRenamed("leader", "failed").join(shared, "key").where(F.expr("array_contains(left, value)"))
                 .select("failed", "key", "value"), "failed")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each connected component of ``edges`` (u, v).

    Each round every node takes the smallest label around it and then its label's label; every round's
    labels are a written table, and only the count of changes comes to the driver.
    """
    both = cut_lineage(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = cut_lineage(both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("v"), "label"), "v").groupBy("u").agg(F.min("label").alias("around"))
        step = labels.join(near, labels["node"] == near["u"]).select("node", "label", F.least("label", "around").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("label").alias("far"))
        after = cut_lineage(step.join(jump, "to").select("node", F.col("label").alias("was"), F.least("to", "far").alias("label")), "labels")
        labels = after.select("node", "label")
        if after.where("label <> was").isEmpty():
            return labels


def near_duplicate_classes(spark: SparkSession, docs: DataFrame, text: str = "text") -> DataFrame:
    """One row a document: doc_id, key, class_key (both null for texts without a word)."""
    rows = sketched(spark, docs, text)
    labels = classes(rows)
    return rows.select("doc_id", "key").join(labels.withColumnRenamed("node", "key"), "key", "left") \
        .select("doc_id", "key", F.coalesce("label", "key").alias("class_key"))


def one_of_each(spark: SparkSession, docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without near duplicates: of each class the row with the smallest doc_id stays (null ids last).

    Rows equal in doc_id and text that win together are reduced to one; texts without a word all stay.
    """
    classes = near_duplicate_classes(spark, docs, text).where(F.col("key").isNotNull())
    winner = classes.groupBy("class_key").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("w")) \
        .select(F.col("w.doc_id").alias("_id"), F.col("w.key").alias("_key"))
    repeated = classes.groupBy(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    kept = cut_lineage(winner.join(repeated, winner["_id"].eqNullSafe(repeated["_id"]) & (winner["_key"] == repeated["_key"]))
                       .select(winner["_id"], winner["_key"], "_rows"), "kept")
    own = F.when(docs[text].rlike(r"[^\x20\x09-\x0D]"), F.xxhash64(docs[text]))
    keyed = packed(docs, own.alias("_own"), docs["doc_id"].alias("_doc"))

    def held(part: DataFrame) -> DataFrame:
        return keyed.join(part, (keyed["_own"] == part["_key"]) & keyed["_doc"].eqNullSafe(part["_id"]), "left_semi")
    once, again = held(kept.where("_rows = 1")), held(kept.where("_rows > 1")).dropDuplicates(["_doc", "_own"])
    return unpacked(once.unionByName(again).unionByName(keyed.where(F.col("_own").isNull())))
