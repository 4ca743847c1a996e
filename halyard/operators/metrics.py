"""Model evaluation metrics as DataFrame aggregates.

Everything is an aggregate over the scored table; cumulative counts over
sorted scores (AUC, ROC) use a range-partitioned prefix sum: running sums
inside each range partition plus the totals of the earlier partitions, so
no single task sees the whole score column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halyard.operators.prefix import running_totals

# Fixed value: the histogram of predicted probabilities has 30 bins.
HIST_BINS = 30


def prefix_sums(df: DataFrame, order_col: str, sum_cols, parts: int | None = None,
                descending: bool = False) -> DataFrame:
    """Add ``cum_<c>``: sum of ``c`` over rows with order_col <= (>= if descending) this row.

    ``df`` must have one row per ``order_col`` value (pre-aggregate first).
    """
    key = F.col(order_col).desc() if descending else F.col(order_col).asc()
    return running_totals(df, [], [key], sum_cols, parts=parts)


def _score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    return df.groupBy(score).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("neg"))


def auc_score(df: DataFrame, label: str = "churn", score: str = "churn_probability", parts: int | None = None) -> DataFrame:
    """Exact ROC AUC (ties count one half), via the rank-sum identity."""
    counts = _score_counts(df, label, score)
    cum = prefix_sums(counts, score, ["neg"], parts)
    # negatives strictly below this score = cum_neg - neg
    contrib = cum.select((F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") * 0.5)).alias("c"),
                         "pos", "neg")
    agg = contrib.agg(F.sum("c").alias("u"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    # one class only: no pair to rank, so no AUC
    return agg.select(F.try_divide(F.col("u"), F.col("n_pos") * F.col("n_neg")).alias("auc"), "n_pos", "n_neg")


def roc_points(df: DataFrame, label: str = "churn", score: str = "churn_probability", parts: int | None = None) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, predicting positive when score >= threshold."""
    counts = _score_counts(df, label, score)
    cum = prefix_sums(counts, score, ["pos", "neg"], parts, descending=True)
    tot = counts.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return cum.crossJoin(F.broadcast(tot)).select(
        F.col(score).alias("threshold"),
        F.try_divide(F.col("cum_neg"), F.col("N")).alias("fpr"),
        F.try_divide(F.col("cum_pos"), F.col("P")).alias("tpr"))


def confusion_matrix(df: DataFrame, label: str = "churn", pred: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("actual"), F.col(pred).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, label: str = "churn", pred: str = "prediction") -> DataFrame:
    """Per-class precision / recall / f1 / support, macro and weighted averages, accuracy.

    Everything comes from the confusion table (one row per pair of classes): the input is read once.
    """
    cells = confusion_matrix(df, label, pred)
    # each cell counts for its actual class and for its predicted one
    sides = cells.select(F.explode(F.array(
        F.struct(F.col("actual").alias("cls"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("n_pred"),
                 F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col("predicted").alias("cls"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("n_pred"),
                 F.lit(0).cast("bigint").alias("tp")))).alias("s")).select("s.*")
    t = sides.groupBy("cls").agg(*[F.sum(c).alias(c) for c in ("support", "n_pred", "tp")])
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("n_pred")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    rows = t.select(F.col("cls").cast("string").alias("class"), prec.alias("precision"), rec.alias("recall"), "support", "tp")
    rows = rows.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                                         F.col("precision") + F.col("recall")), F.lit(0.0)))
    # one row per class: the three summary rows are one aggregate over them, stacked
    total = F.sum("support")

    def weighted(c: str):
        return F.try_divide(F.sum(F.col(c) * F.col("support")), total)
    none = F.lit(None).cast("double")
    summary = rows.agg(F.array(
        F.struct(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                 F.avg("f1").alias("f1"), total.alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), weighted("precision").alias("precision"), weighted("recall").alias("recall"),
                 weighted("f1").alias("f1"), total.alias("support")),
        F.struct(F.lit("accuracy").alias("class"), none.alias("precision"), none.alias("recall"),
                 F.try_divide(F.sum("tp"), total).alias("f1"), total.alias("support"))).alias("s"))
    cols = ["class", "precision", "recall", "f1", "support"]
    return rows.select(cols).unionByName(summary.select(F.explode("s").alias("s")).select(*[f"s.{c}" for c in cols]))


def score_histogram(df: DataFrame, score: str = "churn_probability", bins: int = HIST_BINS) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is closed (numpy semantics)."""
    rng = df.agg(F.min(score).alias("_lo"), F.max(score).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.least(F.floor(F.try_divide(F.col(score) - F.col("_lo"), width)), F.lit(bins - 1))
    binned = df.select(score).crossJoin(F.broadcast(rng)).select(F.coalesce(b, F.lit(0)).cast("int").alias("bin"),
                                                                 "_lo", "_hi")
    return binned.groupBy("bin", "_lo", "_hi").agg(F.count(F.lit(1)).alias("n")).select(
        "bin", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("bin") / bins).alias("bin_start"),
        (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("bin") + 1) / bins).alias("bin_end"), "n")


def regression_metrics(df: DataFrame, pairs) -> DataFrame:
    """mse, mae, r2 per target (``pairs`` = [(target, true_col, pred_col)]) and the uniform average.

    One aggregate over the input; r2 is NULL for a target that does not vary.
    """
    per = []
    for name, yt, yp in pairs:
        known = F.col(yt).isNotNull() & F.col(yp).isNotNull()
        y, err = F.when(known, F.col(yt)), F.when(known, F.col(yt) - F.col(yp))
        per.append(F.struct(F.lit(name).alias("target"), F.avg(err * err).alias("mse"), F.avg(F.abs(err)).alias("mae"),
                            (1 - F.try_divide(F.sum(err * err), F.var_pop(y) * F.count(y))).alias("r2")))
    rows = df.agg(F.array(*per).alias("_m"))

    def mean(field: str):
        known = F.filter("_m", lambda m: m[field].isNotNull())
        return F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, m: a + m[field]), F.size(known))
    overall = F.struct(F.lit("overall").alias("target"), *[mean(f).alias(f) for f in ("mse", "mae", "r2")])
    return rows.select(F.explode(F.concat("_m", F.array(overall))).alias("_m")).select("_m.*")


def anova_f(df: DataFrame, features, label: str = "churn") -> DataFrame:
    """One-way ANOVA F of each feature across label classes (f_classif)."""
    long = df.select(F.col(label).alias("_y"), *[F.col(c).cast("double").alias(c) for c in features]) \
        .unpivot(["_y"], list(features), "feature", "x")
    g = long.groupBy("feature", "_y").agg(F.count("x").alias("n"), F.sum("x").alias("s"),
                                          F.sum(F.col("x") * F.col("x")).alias("ss"))
    t = g.groupBy("feature").agg(
        F.sum("n").alias("N"), F.count(F.lit(1)).alias("k"), F.sum("s").alias("S"), F.sum("ss").alias("SS"),
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("between_raw"))
    ssb = F.col("between_raw") - F.col("S") * F.col("S") / F.col("N")
    ssw = F.col("SS") - F.col("between_raw")
    f = F.try_divide(ssb / (F.col("k") - 1), ssw / (F.col("N") - F.col("k")))
    return t.select("feature", f.alias("f_score"))


def select_k_best(scores: DataFrame, k: int = 20) -> DataFrame:
    """Top-k features by F score (name breaks ties); k is the feature's own limit."""
    return scores.where(F.col("f_score").isNotNull()).orderBy(F.col("f_score").desc(), F.col("feature")).limit(k)
