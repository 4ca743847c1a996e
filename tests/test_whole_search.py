"""The search and the tuned model take every labelled row, however many; there is no sample."""

from types import SimpleNamespace

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from halyard.operators import ml as ML
from halyard.plans import q_ml as QM

ROWS = 2_500  # of the training split


@pytest.fixture(scope="module")
def feats(spark):
    t = spark.range(ROWS + 500)
    return t.select(F.col("id").alias(ML.KEY), (F.col("id") % 3 == 0).cast("int").alias(ML.LABEL),
                    F.when(F.col("id") < ROWS, "train").otherwise("test").alias("split"),
                    array_to_vector(F.array((F.col("id") % 7).cast("double"), (F.col("id") % 5).cast("double"))).alias("features"))


@pytest.fixture
def searched(monkeypatch):
    """A search records its rows and points and likes the last point best."""
    seen = []

    class Search:
        def __init__(self, estimatorParamMaps, **more):
            self.points = estimatorParamMaps

        def fit(self, train):
            seen.append((train.count(), self.points))
            return SimpleNamespace(getEstimatorParamMaps=lambda: self.points, avgMetrics=[i / 100 for i in range(len(self.points))])
    monkeypatch.setattr(ML, "CrossValidator", Search)
    return seen


def test_the_search_takes_all_training_rows(spark, feats, searched):
    _, rows = QM._tune(spark, feats, "logistic_regression")
    (n, points), = searched
    assert n == ROWS and rows.count() == len(points) == 12
    assert {round(1 / (p * ROWS), 6) for point in points for q, p in point.items() if q.name == "regParam"} == set(ML.LR_GRID["C"])


def test_a_bound_on_the_rows_refuses_and_never_samples(feats, searched):
    with pytest.raises(ValueError):
        ML.tune_best("logistic_regression", feats, tune_rows=100)
    assert not searched
