"""Churn and workload models on Spark ML, plus the exact feature transforms.

Fits and scoring run on executors (``pyspark.ml``); what reaches the driver
is model state whose size is bounded by the feature count (coefficients,
importances), never the data; category values stay in a table.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StandardScaler, UnivariateFeatureSelector, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halyard.functions.scalar import churn_decision, clamp_count, clamp_unit
from halyard.operators import dictionary as D
from halyard.operators import metrics as M
from halyard.operators.customer import NUMERIC_TYPES
from halyard.operators.prefix import running_totals
from halyard.session import cut_lineage

LABEL = "churn"
KEY = "customer_id"
SEED = 42

# Fixed values that must equal the reference's configuration.
TEST_SIZE, VALIDATION_SIZE = 0.2, 0.2
K_BEST = 20
RF_PARAMS = {"numTrees": 100, "maxDepth": 10}
GBT_PARAMS = {"maxIter": 100, "maxDepth": 6, "stepSize": 0.1}
LR_PARAMS = {"maxIter": 1000, "C": 1.0}
CV_FOLDS = 5
RF_GRID = {"numTrees": [100, 200, 300], "maxDepth": [10, 15, 20, 30], "minInstancesPerNode": [1, 2, 4]}
GBT_GRID = {"maxIter": [100, 200, 300], "maxDepth": [3, 6, 9], "stepSize": [0.01, 0.1, 0.2],
            "subsamplingRate": [0.8, 0.9, 1.0]}
LR_GRID = {"C": [0.001, 0.01, 0.1, 1.0, 10.0, 100.0], "elasticNetParam": [1.0, 0.0]}
PERFORMANCE_THRESHOLD, DRIFT_THRESHOLD = 0.8, 0.05
TOP_IMPORTANCES = 10
FIT_ROWS = 20_000  # rows of a task of a fit, until every core has one


# ---- exact transforms (SQL-checkable) -------------------------------------------------

def string_columns(df: DataFrame, exclude=(LABEL,)) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType))
            and f.name not in exclude]


def numeric_columns(df: DataFrame, exclude=(LABEL, KEY)) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def label_encode(df: DataFrame, cols=None, words: DataFrame | None = None):
    """Replace string columns by ``<col>_encoded``; returns (table, dictionary).  Values that a given dictionary lacks get
    the index after its last."""
    cols = cols or string_columns(df)
    words = words if words is not None else D.dictionary(df, cols)
    return D.encode(df, words, cols).drop(*cols), words


def unknown_categories(fitted: DataFrame, new: DataFrame, cols) -> DataFrame:
    """(column, value) pairs present in ``new`` but not in ``fitted``: one pass over each, values as rows."""
    return D.value_pairs(new, cols).join(D.value_pairs(fitted, cols), ["column", "value"], "left_anti")


def standard_scale(df: DataFrame, cols=None, stats: DataFrame | None = None):
    """z-score with the population std; zero variance divides by 1.  Returns (table, stats row)."""
    cols = cols or numeric_columns(df)
    if stats is None:
        stats = df.agg(*[F.avg(c).alias(f"_mu_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_sd_{c}") for c in cols])
    t = df.crossJoin(F.broadcast(stats))  # one-row side
    out = []
    for f in df.schema.fields:
        c = f.name
        if c in cols:
            sd = F.col(f"_sd_{c}")
            out.append(((F.col(c) - F.col(f"_mu_{c}")) / F.when((sd == 0) | sd.isNull(), 1.0).otherwise(sd)).alias(c))
        else:
            out.append(F.col(c))
    return t.select(*out), stats


def stratified_split(df: DataFrame, label: str = LABEL, key: str = KEY, seed: int = SEED,
                     test_size: float = TEST_SIZE, val_size: float = VALIDATION_SIZE) -> DataFrame:
    """Exact, repeatable stratified train / validation / test assignment (``split`` column).

    Rows are ordered per class by a seeded integer hash of the key; the first
    ceil(test_size * n_c) are test, the next ceil(val_size / (1 - test_size)
    * rest) validation.  The per-class rank uses the skew-safe prefix
    operator: a class holding most rows is still spread over many tasks.
    """
    # the key modulo 2^31 first: the product then stays within a long for any key
    h = (F.pmod(F.col(key), F.lit(2147483648)) * F.lit(2654435761) + F.lit(seed)) % F.lit(4294967296)
    base = df.withColumn("_h", h)
    ranked = running_totals(base, [label], [F.col("_h").asc(), F.col(key).asc()], rank_col="_rk")
    n = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    t = ranked.join(F.broadcast(n), label)  # one row per class
    n_test = F.ceil(F.col("_n") * test_size)
    n_val = F.ceil((F.col("_n") - n_test) * (val_size / (1 - test_size)))
    split = F.when(F.col("_rk") <= n_test, "test").when(F.col("_rk") <= n_test + n_val, "validation").otherwise("train")
    return t.withColumn("split", split).drop("_h", "_rk", "_n")


# ---- Spark ML pipelines ------------------------------------------------------------------

def spread(df: DataFrame, key: str = KEY, rows: int | None = None) -> DataFrame:
    """``df`` dealt evenly over the tasks of a fit: one for FIT_ROWS rows, at most one a core.

    Every task of a tree fit gives the statistics of all nodes, however few its rows, so small tables stay in one; of
    a large one every task needs its share, where the split's ranges leave some without a training row.
    """
    rows = df.count() if rows is None else rows
    tasks = min(df.sparkSession.sparkContext.defaultParallelism, -(-rows // FIT_ROWS))
    return df.repartition(tasks, key).sortWithinPartitions(key) if tasks > 1 else df.coalesce(1)


def at_once(spark: SparkSession, jobs: Sequence[Callable]) -> list:
    """The results of ``jobs`` in order; as many run side by side as there are cores."""
    if not jobs:
        return []
    with ThreadPool(min(len(jobs), spark.sparkContext.defaultParallelism)) as pool:
        return pool.map(inheritable_thread_target(spark)(lambda job: job()), jobs, chunksize=1)


@dataclass
class FeatureModel:
    """The fitted way from customer rows to feature vectors: a dictionary table, then a Spark ML pipeline."""
    words: DataFrame
    categories: list[str]
    pipeline: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        return self.pipeline.transform(D.encode(df, self.words, self.categories))

    @property
    def feature_names(self) -> list[str]:
        """Names of the selected features, in the vector's order."""
        names = self.pipeline.stages[0].getInputCols()
        last = self.pipeline.stages[-1]
        return [names[i] for i in last.selectedFeatures] if hasattr(last, "selectedFeatures") else names


def fit_features(df: DataFrame, k: int = K_BEST, select: bool = True) -> FeatureModel:
    """Encode strings, assemble numeric + encoded columns, scale, keep the k best by ANOVA F; fitted on ``df``."""
    cats = string_columns(df)
    nums = numeric_columns(df)
    words = D.dictionary(df, cats)
    stages = [VectorAssembler(inputCols=nums + [f"{c}_encoded" for c in cats], outputCol="raw_features", handleInvalid="keep"),
              StandardScaler(inputCol="raw_features", outputCol="scaled_features", withMean=True, withStd=True)]
    if select:
        stages.append(UnivariateFeatureSelector(featuresCol="scaled_features", outputCol="features", labelCol=LABEL,
                                                selectionMode="numTopFeatures")
                      .setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(k))
    else:
        stages[-1].setOutputCol("features")
    return FeatureModel(words, cats, Pipeline(stages=stages).fit(D.encode(df, words, cats)))


def classifiers(n_rows: int | None = None) -> dict:
    """The three churn models with the reference's settings (C=1 L2 -> regParam = 1 / (C * n)).

    The boosted model is Spark's GBT in place of the reference's XGBoost (not available here).
    """
    reg = 1.0 / (LR_PARAMS["C"] * n_rows) if n_rows else 0.0
    return {
        "random_forest": RandomForestClassifier(labelCol=LABEL, featuresCol="features", seed=SEED, **RF_PARAMS),
        "gradient_boosting": GBTClassifier(labelCol=LABEL, featuresCol="features", seed=SEED, **GBT_PARAMS),
        "logistic_regression": LogisticRegression(labelCol=LABEL, featuresCol="features",
                                                  maxIter=LR_PARAMS["maxIter"], regParam=reg, elasticNetParam=0.0),
    }


def positive_probability(pred: DataFrame) -> DataFrame:
    return pred.withColumn("churn_probability", vector_to_array("probability")[1])


def auc_of(pred: DataFrame) -> DataFrame:
    return M.auc_score(positive_probability(pred), LABEL, "churn_probability")


@dataclass
class ChurnRun:
    feature_model: FeatureModel | None
    models: dict = field(default_factory=dict)
    leaderboard: DataFrame | None = None
    best_name: str | None = None


def model_leaderboard(spark: SparkSession, features: DataFrame, names=None) -> ChurnRun:
    """Fit each classifier on the train split, score validation AUC; one row per model."""
    train = features.where(F.col("split") == "train")
    val = features.where(F.col("split") == "validation")
    n = train.count()
    models = classifiers(n)
    names = list(names or models)
    run = ChurnRun(feature_model=None)
    run.models = dict(zip(names, at_once(spark, [lambda name=name: models[name].fit(train) for name in names])))
    rows = [auc_of(m.transform(val)).select(F.lit(name).alias("model"), F.col("auc").alias("validation_auc"))
            for name, m in run.models.items()]
    lb = rows[0]
    for r in rows[1:]:
        lb = lb.unionByName(r)
    run.leaderboard = lb
    return run


def best_model_argmax(leaderboard: DataFrame, order=None) -> DataFrame:
    """Best validation score; the first listed model wins ties."""
    names = order or list(classifiers().keys())
    pos = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("model"))
    w = Window.orderBy(F.col("validation_auc").desc(), pos)  # one row per model: tiny
    return leaderboard.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def param_grid(estimator, grid: dict, n_rows: int):
    """Every point of ``grid``; C becomes regParam = 1 / (C * n)."""
    b = ParamGridBuilder()
    for pname, values in grid.items():
        if pname == "C":
            b = b.addGrid(estimator.getParam("regParam"), [1.0 / (c * n_rows) for c in values])
        else:
            b = b.addGrid(estimator.getParam(pname), values)
    return b.build()


GRIDS = {"random_forest": RF_GRID, "gradient_boosting": GBT_GRID, "logistic_regression": LR_GRID}


def tune_best(name: str, train: DataFrame, tune_rows: int | None = None, folds: int = CV_FOLDS, parallelism: int | None = None):
    """k-fold search over the whole grid of model ``name`` on all labelled rows, scored by AUC; returns the CrossValidatorModel.

    ``tune_rows``: a caller may refuse larger tables; more rows are an error, never a sample.
    ``parallelism``: grid points fitted side by side (None: one a core).
    """
    n = train.count()
    if tune_rows is not None and n > tune_rows:
        raise ValueError(f"the search takes all {n} labelled rows; {tune_rows} are allowed")
    train = spread(train.select(KEY, LABEL, "features"), rows=n).persist()
    parallelism = parallelism or train.sparkSession.sparkContext.defaultParallelism
    estimator = classifiers(n)[name]
    ev = BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol="rawPrediction", metricName="areaUnderROC")
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=param_grid(estimator, GRIDS[name], n),
                        evaluator=ev, numFolds=folds, seed=SEED, parallelism=parallelism)
    try:
        return cv.fit(train)
    finally:
        train.unpersist()


def best_params(cv) -> dict:
    """The grid point of the best mean score, the first of equals."""
    return cv.getEstimatorParamMaps()[max(range(len(cv.avgMetrics)), key=lambda i: cv.avgMetrics[i])]


def fit_tuned(name: str, cv, train: DataFrame):
    """Model ``name`` with the best grid point of ``cv``, fitted on ``train``, the rows that were searched."""
    estimator = classifiers(train.count())[name]
    for param, value in best_params(cv).items():
        estimator.set(estimator.getParam(param.name), value)
    return estimator.fit(train)


def evaluate_holdout(model, test: DataFrame) -> dict[str, DataFrame]:
    pred = positive_probability(model.transform(test)).select(KEY, LABEL, F.col("prediction").cast("int").alias("prediction"), "churn_probability")
    pred = cut_lineage(pred, "scored")  # every metric reads it
    return {"auc": M.auc_score(pred, LABEL, "churn_probability"),
            "report": M.classification_report(pred, LABEL, "prediction"),
            "confusion": M.confusion_matrix(pred, LABEL, "prediction"),
            "predictions": pred}


def importance_topk(spark: SparkSession, model, feature_names, k: int = TOP_IMPORTANCES) -> DataFrame:
    """Feature importances (size = feature count) as a table, top k descending."""
    imp = model.featureImportances.toArray().tolist()
    rows = [(feature_names[i] if i < len(feature_names) else f"f{i}", float(v)) for i, v in enumerate(imp)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), F.col("feature")).limit(k)


def score_customers(feature_model: FeatureModel, model, customers: DataFrame) -> DataFrame:
    """Batch scoring: probability, decision, risk level, confidence."""
    pred = positive_probability(model.transform(feature_model.transform(customers)))
    return churn_decision(pred.select(KEY, "churn_probability"))


def save_model(features: FeatureModel, model, path: str, metrics: dict | None = None, version: str = "1.0.0") -> str:
    """Persist dictionary, feature pipeline and model; metrics and version go to a JSON side file next to them."""
    PipelineModel(stages=[*features.pipeline.stages, model]).write().overwrite().save(f"{path}/model")
    features.words.write.mode("overwrite").parquet(f"{path}/words")
    spark = SparkSession.getActiveSession()
    meta = json.dumps({"version": version, "metrics": metrics or {}, "categories": features.categories})
    spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")
    return path


def load_model(path: str) -> tuple[FeatureModel, dict]:
    """The persisted dictionary with one pipeline of features and model, and the side file."""
    spark = SparkSession.getActiveSession()
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    return FeatureModel(spark.read.parquet(f"{path}/words"), meta["categories"], PipelineModel.load(f"{path}/model")), meta


def retrain_gate(current: DataFrame, candidate: DataFrame, metric: str = "validation_auc",
                 drift: float = DRIFT_THRESHOLD, floor: float = PERFORMANCE_THRESHOLD) -> DataFrame:
    """Deploy the candidate only if it beats the current model; flag drift and low performance."""
    c = current.select(F.col(metric).alias("current"))
    n = candidate.select(F.col(metric).alias("candidate"))
    t = c.crossJoin(n)
    return t.select("current", "candidate", (F.col("candidate") > F.col("current")).alias("deploy"),
                    (F.abs(F.col("candidate") - F.col("current")) > drift).alias("drift_detected"),
                    (F.col("candidate") < floor).alias("below_threshold"))


# ---- workload forecasting ----------------------------------------------------------------

WORKLOAD_TARGETS = ["cpu_usage", "memory_usage", "job_queue_length"]
FORECAST_TARGETS = [*WORKLOAD_TARGETS, "gpu_usage"]


def regressors() -> dict:
    return {
        "random_forest": RandomForestRegressor(numTrees=100, maxDepth=10, seed=SEED),
        "gradient_boosting": GBTRegressor(maxIter=100, stepSize=0.1, maxDepth=6, seed=SEED),
        "ridge": LinearRegression(regParam=1.0, elasticNetParam=0.0),
        "linear": LinearRegression(regParam=0.0),
    }


AUTO_SELECT_CANDIDATES = ["random_forest", "ridge", "linear"]


def workload_feature_columns(features: DataFrame, ts: str, targets=WORKLOAD_TARGETS, extra_exclude=()) -> list[str]:
    skip = {ts, "split", "series_id", *targets, *extra_exclude}
    return [f.name for f in features.schema.fields if f.name not in skip and isinstance(f.dataType, NUMERIC_TYPES)]


def workload_assembler(cols) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=list(cols), outputCol="raw_features"),
                            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)])


@dataclass
class WorkloadModel:
    scaler: PipelineModel
    models: dict
    model_type: str
    feature_cols: list
    metrics: DataFrame


def train_workload_model(features: DataFrame, ts: str, model_type: str = "random_forest",
                         targets=WORKLOAD_TARGETS) -> WorkloadModel:
    """One regressor per target on the chronological train split; metrics on train and test.

    ``model_type`` "auto" takes the regressor that ``auto_select_regressor`` puts first.
    """
    if model_type == "auto":
        model_type = auto_select_regressor(features, ts, targets).orderBy(F.col("cv_r2").desc(), "model").first()["model"]
    cols = workload_feature_columns(features, ts, targets)
    train = features.where(F.col("split") == "train")
    test = features.where(F.col("split") == "test")
    scaler = workload_assembler(cols).fit(train)
    tr, te = scaler.transform(train), scaler.transform(test)
    models, preds_tr, preds_te = {}, tr, te
    for t in targets:
        est = regressors()[model_type].copy().setLabelCol(t).setFeaturesCol("features").setPredictionCol(f"pred_{t}")
        models[t] = est.fit(tr)
        preds_tr = models[t].transform(preds_tr)
        preds_te = models[t].transform(preds_te)
    m_tr = M.regression_metrics(preds_tr, [(t, t, f"pred_{t}") for t in targets]).withColumn("split", F.lit("train"))
    m_te = M.regression_metrics(preds_te, [(t, t, f"pred_{t}") for t in targets]).withColumn("split", F.lit("test"))
    return WorkloadModel(scaler, models, model_type, cols, m_tr.unionByName(m_te))


def auto_select_regressor(features: DataFrame, ts: str, targets=WORKLOAD_TARGETS, folds: int = CV_FOLDS,
                          names=None) -> DataFrame:
    """Mean k-fold R2 over all targets per regressor, with contiguous time folds; the best one first.

    Like the reference, gradient boosting takes no part in auto-selection
    (there it fails on the multi-target fit and is skipped).
    """
    cols = workload_feature_columns(features, ts, targets)
    train = features.where(F.col("split") == "train")
    n = train.count()
    idx = running_totals(train, [], [F.col(ts).asc()], rank_col="_rk")
    folded = idx.withColumn("fold", F.floor((F.col("_rk") - 1) * folds / F.lit(n)).cast("int")).drop("_rk")
    if n < folds:
        raise ValueError(f"{folds} folds need as many training rows; there are {n}")
    prepared = workload_assembler(cols).fit(folded).transform(folded).select(ts, "fold", *targets, "features")
    prepared = cut_lineage(spread(prepared, ts, n), "folds")  # every fit reads it

    def r2(name: str, target: str, fold: int) -> float:
        est = regressors()[name].copy().setLabelCol(target).setFeaturesCol("features")
        pred = est.fit(prepared.where(F.col("fold") != fold)).transform(prepared.where(F.col("fold") == fold))
        return RegressionEvaluator(labelCol=target, predictionCol="prediction", metricName="r2").evaluate(pred)
    names, targets = list(names or AUTO_SELECT_CANDIDATES), list(targets)
    # the fold models alone are scored, side by side: none is fitted on all rows
    fits = [(name, target, fold) for name in names for target in targets for fold in range(folds)]
    scored = list(zip(fits, at_once(features.sparkSession, [lambda fit=fit: r2(*fit) for fit in fits])))
    rows = []
    for name in names:
        scores = [score for (fitted, _, _), score in scored if fitted == name]
        rows.append((name, sum(scores) / len(scores), len(targets)))
    rows.sort(key=lambda r: -r[1])
    return features.sparkSession.createDataFrame(rows, "model string, cv_r2 double, n_targets int")


def forecast_workload(wm: WorkloadModel, features: DataFrame, ts: str, horizon: int = 24, confidence: float = 0.95,
                      version: str = "1.0.0") -> DataFrame:
    """Flat multi-step forecast from the latest complete feature row (one row per step).

    One column for each of FORECAST_TARGETS; null where ``wm`` has no model of it.  ``lower`` and ``upper`` bound cpu
    use: the forecast and the normal quantile of ``confidence`` times the root of the held-out mean squared error,
    inside 0 to 1; null without a cpu model.
    """
    from statistics import NormalDist

    last = features.agg(F.max(ts).alias("_last"))
    row = features.join(F.broadcast(last), F.col(ts) == F.col("_last")).drop("_last")
    scored = wm.scaler.transform(row)
    for model in wm.models.values():
        scored = model.transform(scored)
    error = wm.metrics.where("split = 'test' and target = 'cpu_usage'").agg(F.sqrt(F.first("mse")).alias("_rmse"))  # one row
    steps = scored.select(F.col(ts).alias("_last"), *[F.col(f"pred_{t}") for t in wm.models]).crossJoin(F.broadcast(error)) \
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))

    def forecast(target: str, clamp) -> Column:
        return (clamp(F.col(f"pred_{target}")) if target in wm.models else F.lit(None).cast("double")).alias(target)
    cpu, reach = forecast("cpu_usage", clamp_unit), F.col("_rmse") * NormalDist().inv_cdf((1 + confidence) / 2)
    return steps.select(
        "step", F.timestamp_add("HOUR", F.col("step"), F.col("_last")).alias("timestamp"), cpu,
        forecast("memory_usage", clamp_unit), forecast("gpu_usage", clamp_unit), forecast("job_queue_length", clamp_count),
        F.when(cpu.isNotNull(), F.greatest(F.lit(0.0), cpu - reach)).alias("lower"),
        F.when(cpu.isNotNull(), F.least(F.lit(1.0), cpu + reach)).alias("upper"),
        F.lit(f"{wm.model_type}-{version}").alias("model_version"))


def model_info(wm: WorkloadModel, n_train: DataFrame) -> DataFrame:
    """One row: model type, feature count, training rows, test r2 (overall)."""
    test_r2 = wm.metrics.where((F.col("split") == "test") & (F.col("target") == "overall")).select(F.col("r2").alias("test_r2"))
    return n_train.crossJoin(test_r2).select(F.lit(wm.model_type).alias("model_type"),
                                             F.lit(len(wm.feature_cols)).alias("feature_count"),
                                             "training_samples", "test_r2")
