"""The registered tuning searches the leaderboard winner's whole grid, and the workflow evaluates that model."""

import math
from types import SimpleNamespace

import pytest

import __spark_entry__ as E
from halyard.operators import ml as ML
from halyard.plans import workflows as W


@pytest.fixture
def searched(spark, monkeypatch):
    """Logistic regression wins; a search records its points and rows and likes the last point best."""
    seen = []

    class Search:
        def __init__(self, estimator, estimatorParamMaps, **more):
            self.estimator, self.points = estimator, estimatorParamMaps

        def fit(self, train):
            seen.append((type(self.estimator).__name__, self.points, train.count()))
            return SimpleNamespace(getEstimatorParamMaps=lambda: self.points, avgMetrics=[i / 100 for i in range(len(self.points))])
    board = [("random_forest", .6), ("gradient_boosting", .6), ("logistic_regression", .7)]
    monkeypatch.setattr(ML, "CrossValidator", Search)
    monkeypatch.setattr(ML, "model_leaderboard", lambda *a: SimpleNamespace(leaderboard=spark.createDataFrame(board, "model string, validation_auc double")))
    return seen


def test_tune_best_searches_the_winners_whole_grid(spark, sf, searched):
    rows = E.queries()["tune_best"](spark, sf).collect()
    (kind, points, n), = searched
    assert kind == "LogisticRegression" and n > 0
    assert len(rows) == len(points) == math.prod(map(len, ML.LR_GRID.values()))


def test_workflow_evaluates_the_tuned_winner(spark, sf, searched, monkeypatch):
    fitted, fit = [], ML.fit_tuned
    monkeypatch.setattr(ML, "fit_tuned", lambda *a: fitted.append(fit(*a)) or fitted[-1])
    status, outs = W.workflow_churn(spark, sf)
    assert [(r["step"], r["status"]) for r in status.collect()] == [(s, "success") for s in ("data", "features", "train", "tune", "evaluate")]
    assert len(searched[0][1]) == outs["tuning"].count() == 12 and outs["evaluation"].count() > 0
    last = list(searched[0][1][-1].values())
    assert fitted[0].getRegParam() in last and fitted[0].getElasticNetParam() in last
