"""Language identification by bit-sliced n-gram Bloom filters.

Every language keeps a Bloom filter of its character trigrams.  The filters share their hash functions and
are stored bit-sliced: slot ``i`` holds one bit per language, so AND-ing a trigram's few slots returns the
mask of all languages that contain it.  A text's per-language popcounts over its trigrams, corrected for
each filter's false-positive rate, decide.

Texts are lower-cased, every run of non-letters becomes one space, and each text is framed by spaces.
Null texts and texts without a letter are ``und`` with score 0; equal corrected counts go to the language
that is first by name.  With no training row at all, every text is ``und``.  Repeated rows are predicted alike, row by
row; an empty table gives no rows; the caller's columns travel as one struct, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halyard.llm.common import bounded_sample, map_text, may_train, packed, small_batches
from halyard.llm.pieces import give_up

UNDETERMINED = "und"
DOCS_PER_LANG = 1500     # bound of the training sample, labelled rows of each language
GRAMS_PER_LANG = 20_000  # bound of each language's trigram set
OWN_SHARE = 0.5          # a language contains a trigram if its rate is this share of the highest rate
MIN_DOCS = 2             # ... and if so many sampled documents have it
SLOT_BITS = 19           # 2^19 slots
HASHES = 3
CHUNK = 1 << 20          # code points of a text handled at once

SCHEMA = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                       T.StructField("coverage", T.DoubleType())])

_letters: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """Code point -> its lower-case code point if it is a letter, else space."""
    global _letters
    if _letters is None:
        t = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                t[c] = ord(low) if len(low) == 1 else c
        _letters = t
    return _letters


def trigrams(text: str) -> Iterator[np.ndarray]:
    """Trigram keys of a text, chunk by chunk; neighbouring chunks share two code points."""
    table, tail = letter_table(), np.array([32], np.uint32)
    for at in range(0, len(text), CHUNK):
        a = table[np.frombuffer(text[at:at + CHUNK].encode("utf-32-le", "surrogatepass"), np.uint32)]
        a = np.concatenate([tail, a])
        if at + CHUNK >= len(text):
            a = np.append(a, np.uint32(32))
        a = a[np.concatenate([[True], (a[1:] != 32) | (a[:-1] != 32)])]
        tail = a[-2:]
        if len(a) >= 3:
            w = a.astype(np.uint64)
            yield (w[:-2] << np.uint64(42)) | (w[1:-1] << np.uint64(21)) | w[2:]


def slots(keys: np.ndarray) -> list[np.ndarray]:
    h = keys * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    mask = np.uint64((1 << SLOT_BITS) - 1)
    return [((h >> np.uint64(SLOT_BITS * i + 5)) & mask).astype(np.int64) for i in range(HASHES)]


class BitSlicedFilters:
    """All languages' Bloom filters, slot-major; ``words`` of 64 language bits per slot."""

    def __init__(self, grams: dict[str, np.ndarray]):
        self.langs = sorted(grams)
        self.words = max(1, -(-len(self.langs) // 64))
        self.bits = np.zeros((self.words, 1 << SLOT_BITS), np.uint64)
        self.false_rate = np.zeros(len(self.langs))
        for i, lang in enumerate(self.langs):
            w, b = divmod(i, 64)
            for s in slots(grams[lang]):
                self.bits[w, s] |= np.uint64(1 << b)
            fill = float(((self.bits[w] >> np.uint64(b)) & np.uint64(1)).mean())
            self.false_rate[i] = fill ** HASHES

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Number of keys each language's filter reports."""
        at, out = slots(keys), np.zeros(len(self.langs), np.int64)
        for w in range(self.words):
            mask = self.bits[w, at[0]]
            for s in at[1:]:
                mask = mask & self.bits[w, s]
            for b in range(min(64, len(self.langs) - 64 * w)):
                out[64 * w + b] = int(((mask >> np.uint64(b)) & np.uint64(1)).sum())
        return out

    def decide(self, text: str | None) -> tuple[str, float, float]:
        n, hits = 0, np.zeros(len(self.langs), np.int64)
        if text and self.langs:
            for keys in trigrams(text):
                n += len(keys)
                hits += self.counts(keys)
        if not n:
            return UNDETERMINED, 0.0, 0.0
        true = np.maximum(hits - n * self.false_rate, 0.0) / (1.0 - self.false_rate)
        best = int(np.argmax(true))
        total = float(true.sum())
        return (self.langs[best], float(true[best] / total) if total else 0.0,
                min(1.0, float(true[best]) / n))


def _gram_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for df in batches:
        for lang, part in df.groupby("lang"):
            keys = [np.unique(np.concatenate([*trigrams(t), np.empty(0, np.uint64)])) for t in part["text"]]
            gram, docs = np.unique(np.concatenate([*keys, np.empty(0, np.uint64)]), return_counts=True)
            yield pd.DataFrame({"lang": lang, "gram": gram.astype(np.int64), "docs": docs.astype(np.int64)})


def learn(spark: SparkSession, docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG,
          grams_per_lang: int = GRAMS_PER_LANG) -> BitSlicedFilters:
    """Filters from at most about ``docs_per_lang`` labelled documents of each language.

    Trigram counts are aggregated in Spark; the driver gets at most ``grams_per_lang`` trigrams a language.
    """
    rows = docs.select("doc_id", "text", "lang").where(may_train() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    picked = bounded_sample(rows, docs_per_lang, F.col("doc_id"), F.col("lang"))
    counts = picked.select("lang", "text").mapInPandas(_gram_counts, "lang string, gram long, docs long") \
        .groupBy("lang", "gram").agg(F.sum("docs").alias("docs"))
    totals = counts.groupBy("lang").agg(F.sum("docs").alias("total"))
    rated = counts.join(totals, "lang").withColumn("rate", F.col("docs") / F.col("total"))
    top = rated.groupBy("gram").agg(F.max("rate").alias("top"))
    own = rated.join(top, "gram").where((F.col("rate") >= OWN_SHARE * F.col("top")) & (F.col("docs") >= MIN_DOCS))
    sets = own.groupBy("lang").agg(
        F.expr(f"slice(sort_array(collect_list(struct(docs, gram)), false), 1, {int(grams_per_lang)}).gram").alias("grams")) \
        .collect()
    return BitSlicedFilters({r["lang"]: np.array(r["grams"], np.int64).astype(np.uint64) for r in sets})


def predict(spark: SparkSession, text: Column, model: BitSlicedFilters) -> Column:
    """Struct column (lang_pred, score, coverage) of whole texts.

    ``score`` is the winner's share of all corrected counts, ``coverage`` the share of the text's trigrams
    that the winner knows.
    """
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # 2^19 slots of 8 bytes for every 64 languages

    def run(texts: list) -> pd.DataFrame:
        give_up()
        filters = shared.value
        return pd.DataFrame([filters.decide(t) for t in texts], columns=SCHEMA.names)
    return map_text(text, run, SCHEMA)


def identify(spark: SparkSession, docs: DataFrame, model: BitSlicedFilters | None = None) -> DataFrame:
    """The rows of ``docs`` as a struct ``_row`` and the struct ``_language`` (lang_pred, score, coverage)."""
    return packed(docs, predict(spark, docs["text"], model or learn(spark, docs)).alias("_language"))
