"""Evaluation metric queries over model-free scores and naive forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from halyard.functions import scalar as S
from halyard.operators import metrics as M
from halyard.operators import timeseries as TS
from halyard.plans.q_customer import MERGED_SQL, SRC, merged
from halyard.plans.registry import R, register, round_doubles
from halyard.sources import fixtures as X

SC = ("churn_scores",)
PRED_SQL = "CAST(CASE WHEN churn_probability > 0.5 THEN 1 ELSE 0 END AS INT)"


def scored(spark, sf):
    s = X.churn_scores(spark, sf)
    return s.withColumn("prediction", (F.col("churn_probability") > 0.5).cast("int"))


@register("confusion_matrix", f"""
SELECT churn AS actual, {PRED_SQL} AS predicted, COUNT(*) AS n FROM churn_scores GROUP BY 1, 2""", fixtures=SC)
def q_confusion_matrix(spark, sf):
    return M.confusion_matrix(scored(spark, sf))


_REPORT_SQL = f"""
, p AS (SELECT churn AS y, {PRED_SQL} AS yhat FROM churn_scores),
cls AS (SELECT y AS c FROM p UNION SELECT yhat FROM p),
t AS (SELECT c, (SELECT COUNT(*) FROM p WHERE y = c) AS support, (SELECT COUNT(*) FROM p WHERE yhat = c) AS n_pred,
             (SELECT COUNT(*) FROM p WHERE y = c AND yhat = c) AS tp FROM cls),
r AS (SELECT CAST(c AS VARCHAR) AS class, COALESCE(tp / NULLIF(n_pred, 0), 0) AS precision,
             COALESCE(tp / NULLIF(support, 0), 0) AS recall, support FROM t),
r2 AS (SELECT *, COALESCE(2 * precision * recall / NULLIF(precision + recall, 0), 0) AS f1 FROM r)
SELECT class, {R('precision')} AS precision, {R('recall')} AS recall, {R('f1')} AS f1, support FROM r2
UNION ALL SELECT 'macro avg', {R('AVG(precision)')}, {R('AVG(recall)')}, {R("AVG(f1)")}, CAST(SUM(support) AS BIGINT) FROM r2
UNION ALL SELECT 'weighted avg', {R('SUM(precision * support) / SUM(support)')}, {R('SUM(recall * support) / SUM(support)')},
       {R("SUM(f1 * support) / SUM(support)")}, CAST(SUM(support) AS BIGINT) FROM r2
UNION ALL SELECT 'accuracy', NULL, NULL, {R('AVG(CASE WHEN y = yhat THEN 1.0 ELSE 0.0 END)')}, COUNT(*) FROM p"""


@register("classification_report", _REPORT_SQL, fixtures=SC)
def q_classification_report(spark, sf):
    out = M.classification_report(scored(spark, sf))
    return round_doubles(out.withColumn("support", F.col("support").cast("bigint")))


_AUC_SQL = f"""
, c AS (SELECT churn_probability AS s, SUM(CASE WHEN churn = 1 THEN 1 ELSE 0 END) AS pos,
               SUM(CASE WHEN churn = 1 THEN 0 ELSE 1 END) AS neg FROM churn_scores GROUP BY 1),
k AS (SELECT *, SUM(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg FROM c)
SELECT {R('SUM(pos * (cum_neg - neg + neg * 0.5)) / (SUM(pos) * SUM(neg))')} AS auc,
       CAST(SUM(pos) AS BIGINT) AS n_pos, CAST(SUM(neg) AS BIGINT) AS n_neg FROM k"""


@register("auc_score", _AUC_SQL, fixtures=SC)
def q_auc_score(spark, sf):
    out = M.auc_score(X.churn_scores(spark, sf))
    return round_doubles(out.select("auc", F.col("n_pos").cast("bigint"), F.col("n_neg").cast("bigint")))


_ROC_SQL = f"""
, c AS (SELECT churn_probability AS s, SUM(CASE WHEN churn = 1 THEN 1 ELSE 0 END) AS pos,
               SUM(CASE WHEN churn = 1 THEN 0 ELSE 1 END) AS neg FROM churn_scores GROUP BY 1),
k AS (SELECT s, SUM(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp,
             SUM(neg) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn,
             SUM(pos) OVER () AS P, SUM(neg) OVER () AS N FROM c)
SELECT {R('s')} AS threshold, {R('cn / N')} AS fpr, {R('cp / P')} AS tpr FROM k"""


@register("roc_points", _ROC_SQL, fixtures=SC)
def q_roc_points(spark, sf):
    return round_doubles(M.roc_points(X.churn_scores(spark, sf)))


_HIST_SQL = f"""
, m AS (SELECT MIN(churn_probability) AS lo, MAX(churn_probability) AS hi FROM churn_scores),
b AS (SELECT CAST(COALESCE(LEAST(FLOOR((churn_probability - lo) / ((hi - lo) / 30)), 29), 0) AS INT) AS bin, lo, hi
      FROM churn_scores, m)
SELECT bin, {R('lo + (hi - lo) * bin / 30')} AS bin_start, {R('lo + (hi - lo) * (bin + 1) / 30')} AS bin_end,
       COUNT(*) AS n FROM b GROUP BY bin, lo, hi"""


@register("score_histogram", _HIST_SQL, fixtures=SC)
def q_score_histogram(spark, sf):
    return round_doubles(M.score_histogram(X.churn_scores(spark, sf)))


@register("risk_level", f"""
SELECT customer_id, CASE WHEN churn_probability < 0.3 THEN 'Low' WHEN churn_probability < 0.7 THEN 'Medium'
       ELSE 'High' END AS risk_level FROM churn_scores""", fixtures=SC)
def q_risk_level(spark, sf):
    s = X.churn_scores(spark, sf)
    return s.select("customer_id", S.risk_level(F.col("churn_probability")).alias("risk_level"))


@register("churn_decision", f"""
SELECT customer_id, churn, {R('churn_probability', 4)} AS churn_probability, churn_probability > 0.5 AS churn_prediction,
       CASE WHEN churn_probability < 0.3 THEN 'Low' WHEN churn_probability < 0.7 THEN 'Medium' ELSE 'High' END AS risk_level,
       {R('ABS(churn_probability - 0.5) * 2', 4)} AS confidence FROM churn_scores""", fixtures=SC)
def q_churn_decision(spark, sf):
    out = S.churn_decision(X.churn_scores(spark, sf))
    return round_doubles(out, overrides={"churn_probability": 4, "confidence": 4})


@register("batch_score_summary", """
SELECT COUNT(*) AS total_customers, COUNT(*) FILTER (WHERE churn_probability >= 0.7) AS high_risk_count
FROM churn_scores""", fixtures=SC)
def q_batch_score_summary(spark, sf):
    s = X.churn_scores(spark, sf).select(S.risk_level(F.col("churn_probability")).alias("risk_level"))
    return s.agg(F.count(F.lit(1)).alias("total_customers"),
                 F.count_if(F.col("risk_level") == "High").alias("high_risk_count"))


# ---- regression metrics of the naive (persistence) forecast -----------------------

_REG_TARGETS = ["cpu_usage", "memory_usage", "job_queue_length"]


def _reg_sql():
    parts = []
    for t in _REG_TARGETS:
        e = f"({t} - {t}_lag_1)"
        parts.append(f"""SELECT '{t}' AS target, AVG({e} * {e}) AS mse, AVG(ABS({e})) AS mae,
       1 - SUM({e} * {e}) / (VAR_POP({t}) * COUNT(*)) AS r2 FROM l WHERE {t}_lag_1 IS NOT NULL""")
    body = "\nUNION ALL ".join(parts)
    lags = ", ".join(f"LAG({t}, 1) OVER (ORDER BY timestamp_h) AS {t}_lag_1" for t in _REG_TARGETS)
    return f"""
, l AS (SELECT *, {lags} FROM workload_hourly),
m AS ({body})
SELECT target, {R('mse')} AS mse, {R('mae')} AS mae, {R('r2')} AS r2 FROM m
UNION ALL SELECT 'overall', {R('AVG(mse)')}, {R('AVG(mae)')}, {R('AVG(r2)')} FROM m"""


@register("regression_metrics", _reg_sql(), fixtures=("workload_hourly",))
def q_regression_metrics(spark, sf):
    h = X.workload_hourly(spark, sf)
    lagged = TS.lag_features(h, "timestamp_h", columns=_REG_TARGETS, lags=[1])
    out = M.regression_metrics(lagged, [(t, t, f"{t}_lag_1") for t in _REG_TARGETS])
    return round_doubles(out)


# ---- ANOVA F and top-k over the merged customer table ------------------------------

ANOVA_FEATURES = ["age", "tenure_months", "monthly_charges", "total_charges", "total_transaction_amount",
                  "avg_transaction_amount", "transaction_count", "avg_resolution_time", "support_ticket_count",
                  "avg_monthly_usage_gb", "streaming_services_used"]


def _anova_sql(limit=None):
    union = "\nUNION ALL ".join(f"SELECT '{c}' AS feature, churn AS y, CAST({c} AS DOUBLE) AS x FROM merged"
                                for c in ANOVA_FEATURES)
    tail = f"ORDER BY f_score DESC, feature LIMIT {limit}" if limit else ""
    return MERGED_SQL + f"""
, lng AS ({union}),
g AS (SELECT feature, y, COUNT(x) AS n, SUM(x) AS s, SUM(x * x) AS ss FROM lng GROUP BY feature, y),
tt AS (SELECT feature, SUM(n) AS NN, COUNT(*) AS k, SUM(s) AS S, SUM(ss) AS SS, SUM(s * s / n) AS br FROM g GROUP BY feature),
f AS (SELECT feature, ((br - S * S / NN) / (k - 1)) / NULLIF((SS - br) / (NN - k), 0) AS f_score FROM tt)
SELECT feature, {R('f_score', 4)} AS f_score FROM f WHERE f_score IS NOT NULL {tail}"""


@register("anova_f", _anova_sql(), fixtures=SRC)
def q_anova_f(spark, sf):
    out = M.anova_f(merged(spark, sf), ANOVA_FEATURES)
    return round_doubles(out.where(F.col("f_score").isNotNull()), 4)


@register("select_k_best", _anova_sql(limit=5), fixtures=SRC)
def q_select_k_best(spark, sf):
    return round_doubles(M.select_k_best(M.anova_f(merged(spark, sf), ANOVA_FEATURES), 5), 4)
