"""Spark ML queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from halyard.operators import customer as C
from halyard.operators import ml as ML
from halyard.operators import timeseries as TS
from halyard.plans.q_customer import MERGED_SQL, SRC, merged
from halyard.plans.q_metrics import ANOVA_FEATURES
from halyard.plans.registry import R, register, round_doubles
from halyard.session import cut_lineage, scratch_path
from halyard.sources import fixtures as X

ENC_COLS = ["gender", "contract_type", "payment_method", "internet_service", "last_transaction_date",
            "peak_usage_hours", "usage_trend", "age_group"]
UNKNOWN_COLS = ["gender", "contract_type", "payment_method", "internet_service", "last_transaction_date",
                "peak_usage_hours"]

_DERIVED_SQL = MERGED_SQL + """
, qq AS (SELECT quantile_cont(avg_monthly_usage_gb, 0.33) AS q_33, quantile_cont(avg_monthly_usage_gb, 0.67) AS q_67 FROM merged),
dv AS (SELECT m.* EXCLUDE (last_transaction_date), COALESCE(CAST(m.last_transaction_date AS VARCHAR), '0') AS last_transaction_date,
       CASE WHEN avg_monthly_usage_gb <= q_33 THEN 'Low' WHEN avg_monthly_usage_gb <= q_67 THEN 'Medium' ELSE 'High' END AS usage_trend,
       CASE WHEN age > 0 AND age <= 30 THEN 'Young' WHEN age > 30 AND age <= 50 THEN 'Middle'
            WHEN age > 50 AND age <= 70 THEN 'Senior' WHEN age > 70 AND age <= 100 THEN 'Elder' ELSE 'nan' END AS age_group
  FROM merged m, qq)"""

_SPLIT_SQL = """
, sp_h AS (SELECT customer_id, churn, ((customer_id % 2147483648) * 2654435761 + 42) % 4294967296 AS hh FROM customer_demographics),
sp_r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY churn ORDER BY hh, customer_id) AS rk,
         COUNT(*) OVER (PARTITION BY churn) AS n FROM sp_h),
sp AS (SELECT customer_id, churn, CASE WHEN rk <= CEIL(n * CAST(0.2 AS DOUBLE)) THEN 'test'
       WHEN rk <= CEIL(n * CAST(0.2 AS DOUBLE)) + CEIL((n - CEIL(n * CAST(0.2 AS DOUBLE))) * CAST(0.25 AS DOUBLE)) THEN 'validation'
       ELSE 'train' END AS split FROM sp_r)"""


def churn_table(spark, sf):
    return C.derived_features(merged(spark, sf))


def split_table(spark, sf):
    return ML.stratified_split(churn_table(spark, sf))


# ---- exact transforms --------------------------------------------------------------------

@register("label_encode", _DERIVED_SQL + "\nSELECT customer_id, " + ", ".join(
    f"CAST(DENSE_RANK() OVER (ORDER BY {c}) - 1 AS DOUBLE) AS {c}_encoded" for c in ENC_COLS) + " FROM dv", fixtures=SRC)
def q_label_encode(spark, sf):
    enc, _ = ML.label_encode(churn_table(spark, sf).select("customer_id", *ENC_COLS), ENC_COLS)
    return enc


@register("standard_scale", MERGED_SQL + "\nSELECT customer_id, " + ", ".join(
    f"{R(f'({c} - AVG({c}) OVER ()) / CASE WHEN STDDEV_POP({c}) OVER () = 0 THEN 1 ELSE STDDEV_POP({c}) OVER () END')} AS {c}"
    for c in ANOVA_FEATURES) + " FROM merged", fixtures=SRC)
def q_standard_scale(spark, sf):
    m = merged(spark, sf).select("customer_id", *ANOVA_FEATURES)
    out, _ = ML.standard_scale(m, ANOVA_FEATURES)
    return round_doubles(out)


@register("stratified_split", _SPLIT_SQL + "\nSELECT customer_id, churn, split FROM sp", fixtures=SRC)
def q_stratified_split(spark, sf):
    return ML.stratified_split(X.customer_demographics(spark, sf).select("customer_id", "churn")) \
        .select("customer_id", "churn", "split")


_UNK_PARTS = "\nUNION ALL ".join(
    f"""SELECT DISTINCT '{c}' AS "column", CAST({c} AS VARCHAR) AS value FROM dv2 WHERE split <> 'train'
   AND CAST({c} AS VARCHAR) NOT IN (SELECT CAST({c} AS VARCHAR) FROM dv2 WHERE split = 'train')""" for c in UNKNOWN_COLS)


@register("unknown_categories", _DERIVED_SQL + _SPLIT_SQL + f"""
, dv2 AS (SELECT dv.*, sp.split FROM dv JOIN sp ON dv.customer_id = sp.customer_id)
{_UNK_PARTS}""", fixtures=SRC)
def q_unknown_categories(spark, sf):
    t = split_table(spark, sf)
    return ML.unknown_categories(t.where("split = 'train'"), t.where("split <> 'train'"), UNKNOWN_COLS)


# ---- pipelines and models (rows-only checks) ------------------------------------------------

def _features(spark, sf, select=True):
    t = cut_lineage(split_table(spark, sf), "customers")
    fm = ML.fit_features(t.where("split = 'train'").drop("split"), select=select)
    feats = ML.spread(fm.transform(t).select("customer_id", "churn", "split", "features"), rows=t.count())
    return fm, cut_lineage(feats, "features")  # every fit reads it again


@register("assemble_features")
def q_assemble_features(spark, sf):
    _, feats = _features(spark, sf)
    return feats.select("customer_id", "split", vector_to_array("features").alias("features"))


@register("apply_selection")
def q_apply_selection(spark, sf):
    """Fitted selector applied to the held-out rows: the selected feature values."""
    _, feats = _features(spark, sf)
    return feats.where("split <> 'train'").select("customer_id", vector_to_array("features").alias("selected"))


def _model_query(name):
    def fn(spark, sf):
        _, feats = _features(spark, sf)
        run = ML.model_leaderboard(spark, feats, [name])
        return round_doubles(run.leaderboard)
    register(f"train_{ {'random_forest': 'random_forest', 'gradient_boosting': 'boosted_trees', 'logistic_regression': 'logistic'}[name]}")(fn)


for _n in ["random_forest", "gradient_boosting", "logistic_regression"]:
    _model_query(_n)


@register("model_leaderboard")
def q_model_leaderboard(spark, sf):
    _, feats = _features(spark, sf)
    return round_doubles(ML.model_leaderboard(spark, feats).leaderboard)


@register("best_model_argmax")
def q_best_model_argmax(spark, sf):
    _, feats = _features(spark, sf)
    return round_doubles(ML.best_model_argmax(ML.model_leaderboard(spark, feats).leaderboard))


def _winner(leaderboard) -> str:
    return ML.best_model_argmax(leaderboard).first()["model"]


def _tune(spark, feats, name):
    """Search of the whole grid of model ``name`` on all training rows: (CrossValidatorModel, one row a grid point)."""
    cv = ML.tune_best(name, feats.where("split = 'train'"))
    rows = [(name, str({p.name: v for p, v in pm.items()}), float(m)) for pm, m in zip(cv.getEstimatorParamMaps(), cv.avgMetrics)]
    return cv, spark.createDataFrame(rows, "model string, params string, cv_auc double")


@register("tune_best")
def q_tune_best(spark, sf):
    """The leaderboard winner's whole grid."""
    _, feats = _features(spark, sf)
    return _tune(spark, feats, _winner(ML.model_leaderboard(spark, feats).leaderboard))[1].drop("model")


def _best_rf(spark, sf):
    fm, feats = _features(spark, sf)
    train = feats.where("split = 'train'")
    model = ML.classifiers(train.count())["random_forest"].fit(train)
    return fm, feats, model


@register("evaluate_holdout")
def q_evaluate_holdout(spark, sf):
    _, feats, model = _best_rf(spark, sf)
    res = ML.evaluate_holdout(model, feats.where("split = 'test'"))
    return round_doubles(res["report"].crossJoin(res["auc"].select("auc")))


@register("score_customers")
def q_score_customers(spark, sf):
    fm, _, model = _best_rf(spark, sf)
    return ML.score_customers(fm, model, churn_table(spark, sf))


@register("save_load_model")
def q_save_load_model(spark, sf):
    fm, _, model = _best_rf(spark, sf)
    path = scratch_path(spark, "churn-model")
    ML.save_model(fm, model, path, {"model": "random_forest"})
    loaded, meta = ML.load_model(path)
    pred = ML.positive_probability(loaded.transform(churn_table(spark, sf)))
    return pred.select("customer_id", F.round("churn_probability", 4).alias("churn_probability"),
                       F.lit(meta["version"]).alias("model_version"))


@register("metrics_report")
def q_metrics_report(spark, sf):
    """Write AUC, report and confusion matrix as parquet; read the report back."""
    from halyard.sources.ingest import write_processed
    _, feats, model = _best_rf(spark, sf)
    res = ML.evaluate_holdout(model, feats.where("split = 'test'"))
    base = scratch_path(spark, "churn-report")
    for name in ("auc", "report", "confusion"):
        write_processed(res[name], f"{base}/{name}")
    return spark.read.parquet(f"{base}/report")


@register("importance_topk")
def q_importance_topk(spark, sf):
    fm, _, model = _best_rf(spark, sf)
    return ML.importance_topk(spark, model, fm.feature_names)


@register("retrain_gate")
def q_retrain_gate(spark, sf):
    """Current = logistic regression, candidate = random forest (validation AUC)."""
    _, feats = _features(spark, sf)
    lb = ML.model_leaderboard(spark, feats, ["logistic_regression", "random_forest"]).leaderboard
    return round_doubles(ML.retrain_gate(lb.where("model = 'logistic_regression'"), lb.where("model = 'random_forest'")))


# ---- workload models -------------------------------------------------------------------------

def workload_features(spark, sf):
    """Feature table, written once (reliable checkpoint) so model fits read it instead of re-planning the windows."""
    h = X.workload_hourly(spark, sf)
    feats = cut_lineage(TS.timeseries_features(h, "timestamp_h"))
    return cut_lineage(TS.chrono_split(feats, "timestamp_h"))


@register("train_workload_model")
def q_train_workload_model(spark, sf):
    wm = ML.train_workload_model(workload_features(spark, sf), "timestamp_h", "random_forest")
    return round_doubles(wm.metrics, 4)


@register("auto_select_regressor")
def q_auto_select_regressor(spark, sf):
    return round_doubles(ML.auto_select_regressor(workload_features(spark, sf), "timestamp_h"), 4)


@register("forecast_workload")
def q_forecast_workload(spark, sf):
    feats = workload_features(spark, sf)
    wm = ML.train_workload_model(feats, "timestamp_h", "random_forest", ML.FORECAST_TARGETS)
    return round_doubles(ML.forecast_workload(wm, feats, "timestamp_h", 24), 4)


@register("model_info")
def q_model_info(spark, sf):
    feats = workload_features(spark, sf)
    wm = ML.train_workload_model(feats, "timestamp_h", "ridge")
    n = feats.where("split = 'train'").agg(F.count(F.lit(1)).alias("training_samples"))
    return round_doubles(ML.model_info(wm, n), 4)
