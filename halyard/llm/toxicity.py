"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Lexicons are learned: whole words and word beginnings that stand in toxic training texts far more often than
in others, each with its log odds as weight.  Features are lexicon densities, how near lexicon words stand to
the second person, capitals, punctuation and obfuscation rates.  Trees (Spark ML) learn on most of the training
rows and isotonic regression maps their probability on the rest.  A row's training features come from
lexicons learned without its fold, so the trees see densities as they are in unseen texts.

Only text and label are learned from, and only the text is scored.  Training rows: labelled, not held out, at
most about TRAIN_ROWS by a hash of the id, then one for each distinct text.  Null and empty texts have all features 0 and get
the score of that.  Without rows of both labels every score is the share of toxic rows (0 if none).  Repeated
rows score alike; rows with a null doc_id are scored, never learned from.
"""

from __future__ import annotations

import gc
import math

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halyard.llm.common import bounded_sample, may_train, packed, small_batches
from halyard.llm.pieces import Memory
from halyard.session import cut_lineage

TRAIN_ROWS = 12_000   # bound of the training sample
FOLDS = 4             # the last calibrates
MIN_TOXIC = 3         # toxic training texts that a lexicon entry needs
MIN_LOG_ODDS = 1.2
LEXICON = 2_000       # entries of each lexicon, by weight
STEMS = (4, 5, 6, 7)  # lengths of word beginnings
NEAR = 5              # words between a lexicon word and the second person
THRESHOLD = 0.3

# Second-person words of English, French, German and Spanish.
SECOND_PERSON = frozenset("you your yours yourself u ur tu toi te vous votre vos du dich dir dein deine euch ihr usted ustedes tú ti vosotros".split())
# Characters written for letters.
LOOKALIKES = str.maketrans("013457@$!|", "oieastasil")

FEATURES = ("log_words", "word_hits", "word_density", "word_kinds", "word_weight", "word_top", "stem_hits", "stem_density",
            "stem_kinds", "stem_weight", "stem_top", "stem_mean", "near_you", "capitals", "exclaim", "marks", "obfuscated", "hidden_hits")


def core_of(part: str) -> tuple[str, str]:
    """A part's letters without marks around them, and (if it is disguised) what it reads as."""
    inner = part.strip(".,;:!?\"'()[]{}<>|#%&*$-")
    if inner.isalpha() or not any(c.isalpha() for c in inner):
        return inner, ""
    plain = "".join(c for c in inner.translate(LOOKALIKES) if c.isalpha())
    return "".join(c for c in inner if c.isalpha()), plain


class Features:
    """Feature rows for given lexicons; remembers what each part of a text is."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.lexicons = words, stems
        self._start()

    def __getstate__(self):
        return self.lexicons

    def __setstate__(self, lexicons):
        gc.collect()  # what a worker remembered for earlier lexicons
        self.lexicons = lexicons
        self._start()

    def _start(self) -> None:
        self.entries: list[tuple] = [(0.0, 0.0, "", "", False, False, False)]
        self._codes = Memory(self._code)

    def _code(self, part: str) -> int:
        """0 for a part that says nothing, else the number of its entry."""
        words, stems = self.lexicons
        core, plain = core_of(part)
        stem = max((core[:n] for n in STEMS if core[:n] in stems), key=stems.__getitem__, default="")
        hidden = bool(plain) and plain in words and core not in words
        entry = (words.get(core, 0.0), stems.get(stem, 0.0), core, stem, core in SECOND_PERSON, bool(plain), hidden)
        if not (entry[0] or entry[1] or entry[4] or entry[5]):
            return 0
        self.entries.append(entry)
        return len(self.entries) - 1

    def row(self, text: str | None) -> list[float]:
        parts = text.lower().split() if text else []
        if not parts:
            return [0.0] * len(FEATURES)
        if len(self.entries) > 200_000:
            self._start()
        codes = np.fromiter(map(self._codes.__getitem__, parts), np.int64, len(parts))
        at = np.flatnonzero(codes)
        seen = [self.entries[c] for c in codes[at].tolist()]
        n, per = len(parts), 100.0 / len(parts)
        word = [(i, e) for i, e in zip(at.tolist(), seen) if e[0]]
        stem = [e for e in seen if e[1]]
        you = np.array([i for i, e in zip(at.tolist(), seen) if e[4]], np.int64)
        near = 0
        if word and len(you):
            places = np.array([i for i, _ in word])
            k = np.searchsorted(you, places)
            gap = np.minimum(np.abs(places - you[np.minimum(k, len(you) - 1)]), np.abs(places - you[np.maximum(k - 1, 0)]))
            near = int((gap <= NEAR).sum())
        raw = text.encode("utf-8", "surrogatepass")
        size = len(raw)
        rate = lambda chars: (size - len(raw.translate(None, chars))) / size
        ww, sw = [e[0] for _, e in word], [e[1] for e in stem]
        return [math.log1p(n), len(word), len(word) * per, len({e[2] for _, e in word}), sum(ww) * per, max(ww, default=0.0),
                len(stem), len(stem) * per, len({e[3] for e in stem}), sum(sw) * per, max(sw, default=0.0), sum(sw) / len(sw) if sw else 0.0,
                near / len(word) if word else 0.0, rate(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), rate(b"!?"), rate(b"#*$%&|<>@_~^"),
                sum(e[5] for e in seen) * per, sum(e[6] for e in seen)]


def _terms(batches):
    """(fold, toxic, kind, term) of each distinct word and word beginning of a text, counted in the batch."""
    for df in batches:
        out: dict = {}
        for text, toxic, fold in zip(df["text"], df["toxic"], df["fold"]):
            cores = {core_of(p)[0] for p in text.lower().split()}
            for key in {("word", c) for c in cores if len(c) > 1} | {("stem", c[:n]) for c in cores for n in STEMS if len(c) >= n}:
                both = out.setdefault((int(fold), *key), [0, 0])
                both[int(toxic)] += 1
        yield pd.DataFrame([(f, k, t, c, x) for (f, k, t), (c, x) in out.items()], columns=["fold", "kind", "term", "clean", "toxic"])


def lexicons(train: DataFrame) -> list[tuple[dict, dict]]:
    """For each fold the lexicons learned without it, and last those of all rows.

    Counting is a Spark aggregation; the driver gets the terms of at least MIN_TOXIC toxic texts and a raw log
    odds above the minimum, at most 4 * LEXICON of each kind.
    """
    sizes = {(r["fold"], r["toxic"]): r["n"] for r in train.groupBy("fold", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = train.select("text", "toxic", "fold").mapInPandas(_terms, "fold int, kind string, term string, clean long, toxic long") \
        .groupBy("kind", "term").agg(*[F.sum(F.when(F.col("fold") == f, F.col(c)).otherwise(0)).alias(f"{c}{f}") for f in range(FOLDS) for c in ("clean", "toxic")])
    total = {y: sum(n for (_, t), n in sizes.items() if t == y) for y in (0, 1)}
    clean, toxic = (sum(F.col(f"{c}{f}") for f in range(FOLDS)) for c in ("clean", "toxic"))
    odds = F.log((toxic + 0.5) / (total[1] + 1)) - F.log((clean + 0.5) / (total[0] + 1))
    rows, strong = [], cut_lineage(counts.where((toxic >= MIN_TOXIC) & (odds >= MIN_LOG_ODDS))
                                   .withColumn("strength", odds * F.sqrt(toxic.cast("double"))), "terms")
    for kind in ("word", "stem"):
        rows += strong.where(F.col("kind") == kind).orderBy(F.col("strength").desc(), "term").limit(4 * LEXICON).collect()
    out = []
    for without in [*range(FOLDS), None]:
        folds = [f for f in range(FOLDS) if f != without]
        n = {y: sum(sizes.get((f, y), 0) for f in folds) for y in (0, 1)}
        picked: tuple[dict, dict] = ({}, {})
        for r in rows:
            t, c = (sum(r[f"{name}{f}"] for f in folds) for name in ("toxic", "clean"))
            weight = math.log((t + 0.5) / (n[1] + 1)) - math.log((c + 0.5) / (n[0] + 1))
            if t >= MIN_TOXIC and weight >= MIN_LOG_ODDS:
                picked[r["kind"] == "stem"][r["term"]] = weight
        out.append(tuple(dict(sorted(d.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]) for d in picked))
    return out


def features(spark: SparkSession, text: Column, lexicon: list[tuple[dict, dict]], fold: Column | None = None) -> Column:
    """Vector column of whole texts, by the last lexicons or, given ``fold``, by that fold's."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast([Features(*both) for both in lexicon])  # at most LEXICON entries each

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(texts: pd.Series, folds: pd.Series) -> pd.Series:
        return pd.Series([shared.value[int(f)].row(t) for t, f in zip(texts, folds)], dtype=object)
    return array_to_vector(run(text, F.lit(len(lexicon) - 1) if fold is None else fold))


class Scorer:
    """Lexicons, trees and calibration; or a constant where there was nothing to tell apart."""

    def __init__(self, lexicon, trees, calibration, constant: float):
        self.lexicon, self.trees, self.calibration, self.constant = lexicon, trees, calibration, constant

    def score(self, spark: SparkSession, docs: DataFrame) -> DataFrame:
        """The rows of ``docs`` as a struct ``_row`` and the double ``_score``."""
        if self.trees is None:
            return packed(docs, F.lit(self.constant).alias("_score"))
        x = self.trees.transform(packed(docs, features(spark, docs["text"], self.lexicon).alias("_x")))
        y = self.calibration.transform(x.withColumn("_p", vector_to_array("_prob")[1]))
        # the calibrated steps, with the trees' order kept inside each step
        return y.select("_row", F.least(F.greatest(0.99 * F.col("_iso") + 0.01 * F.col("_p"), F.lit(0.0)), F.lit(1.0)).alias("_score"))


def learn(spark: SparkSession, docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Scorer:
    small_batches(spark)
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)) \
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    # the sample is drawn from the marks, so that only the sampled texts move
    picked = bounded_sample(marks.where(may_train()), train_rows, F.col("doc_id"))
    rows = docs.select("doc_id", "text").where(F.col("text").isNotNull()) \
        .join(F.broadcast(picked), "doc_id").withColumn("key", F.xxhash64("text"))
    # one row a distinct text; copies of a text must not weigh more, nor stand in two folds
    train = cut_lineage(rows.groupBy("key").agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
                        .withColumn("fold", F.pmod(F.xxhash64("key", F.lit("fold")), F.lit(FOLDS)).cast("int")), "toxic")
    share = train.agg(F.avg("toxic").alias("share"), F.count(F.lit(1)).alias("n")).first()
    if not share["n"] or share["share"] in (0.0, 1.0):
        return Scorer(None, None, None, float(share["share"] or 0.0))
    lexicon = lexicons(train)
    x = cut_lineage(train.select(F.col("toxic").cast("double").alias("toxic"), "fold", features(spark, F.col("text"), lexicon, F.col("fold")).alias("_x")), "toxic")
    trees = GBTClassifier(featuresCol="_x", labelCol="toxic", predictionCol="_cut",
                          maxIter=30, maxDepth=4, stepSize=0.15, subsamplingRate=0.8, minInstancesPerNode=5, seed=7).setProbabilityCol("_prob").setRawPredictionCol("_raw")
    held = x.where(F.col("fold") == FOLDS - 1)
    if held.select("toxic").distinct().count() < 2:
        held = x
    model = trees.fit(x.where(F.col("fold") != FOLDS - 1) if x.where(F.col("fold") != FOLDS - 1).select("toxic").distinct().count() == 2 else x)
    probable = model.transform(held).select("toxic", vector_to_array("_prob")[1].alias("_p"))
    calibration = IsotonicRegression(featuresCol="_p", labelCol="toxic", predictionCol="_iso").fit(probable)
    return Scorer(lexicon, model, calibration, float(share["share"]))
