"""The churn workflow searches and fits on all its training rows, and the fit is the point that the search chose."""

from types import SimpleNamespace

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from halyard.operators import ml as ML
from halyard.plans import workflows as W

ROWS = 2_500  # of the training split


def test_the_workflow_tunes_and_fits_on_all_training_rows(spark, monkeypatch):
    t = spark.range(ROWS + 500)
    feats = t.select(F.col("id").alias(ML.KEY), (F.col("id") % 3 == 0).cast("int").alias(ML.LABEL),
                     F.when(F.col("id") < ROWS, "train").otherwise("test").alias("split"),
                     array_to_vector(F.array((F.col("id") % 7).cast("double"), (F.col("id") % 5).cast("double"))).alias("features"))
    searched, fitted, fit = [], [], ML.fit_tuned

    class Search:
        def __init__(self, estimatorParamMaps, **more):
            self.points = estimatorParamMaps

        def fit(self, train):
            searched.append((train.count(), self.points[-1]))
            return SimpleNamespace(getEstimatorParamMaps=lambda: self.points, avgMetrics=[i / 100 for i in range(len(self.points))])
    board = [("random_forest", .6), ("gradient_boosting", .6), ("logistic_regression", .7)]
    monkeypatch.setattr(ML, "CrossValidator", Search)
    monkeypatch.setattr(ML, "model_leaderboard", lambda *a: SimpleNamespace(leaderboard=spark.createDataFrame(board, "model string, validation_auc double")))
    monkeypatch.setattr(ML, "fit_tuned", lambda *a: fitted.append((fit(*a), a[2].count())) or fitted[-1][0])
    monkeypatch.setattr(W.QC, "merged", lambda *a: feats)
    monkeypatch.setattr(W.QM, "_features", lambda *a: (None, feats))
    status, outs = W.workflow_churn(spark, "")
    assert [r["status"] for r in status.collect()] == ["success"] * 5 and outs["evaluation"].count() > 0
    (n, best), = searched
    (model, rows), = fitted
    assert n == rows == ROWS
    assert {p.name: v for p, v in best.items()} == {"regParam": model.getRegParam(), "elasticNetParam": model.getElasticNetParam()}
