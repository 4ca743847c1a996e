"""How the fits lie on the cluster: rows dealt evenly, no fit that nobody reads, independent fits side by side."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from halyard.operators import ml as ML


@pytest.fixture(scope="module")
def hours(spark):
    t = spark.range(100).repartition(8)
    return t.select(F.col("id").alias("h"), (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 5).cast("double").alias("z"),
                    (F.col("id") % 7 * 2 + F.col("id") % 5).cast("double").alias("y"), F.lit("train").alias("split"))


def test_auto_select_fits_each_fold_once_in_one_task(hours, monkeypatch):
    fits = []

    class Counted(LinearRegression):
        def fit(self, df, params=None):
            fits.append((df.count(), df.rdd.getNumPartitions()))
            return super().fit(df, params)
    monkeypatch.setattr(ML, "regressors", lambda: {"linear": Counted(regParam=0.0)})
    row, = ML.auto_select_regressor(hours, "h", ["y"], names=["linear"]).collect()
    assert fits == [(80, 1)] * ML.CV_FOLDS  # no fit of all 100 rows
    assert row["model"] == "linear" and row["n_targets"] == 1 and row["cv_r2"] == pytest.approx(1)


def test_auto_select_needs_a_row_a_fold(hours):
    with pytest.raises(ValueError):
        ML.auto_select_regressor(hours.where("h < 3"), "h", ["y"], names=["linear"])


def test_spread_deals_every_split_over_all_tasks(spark, monkeypatch):
    monkeypatch.setattr(ML, "FIT_ROWS", 1000)
    t = spark.range(4000).select(F.col("id").alias(ML.KEY), F.when(F.col("id") < 3000, "train").otherwise("test").alias("split")) \
        .repartitionByRange(4, ML.KEY)
    tasks = ML.spread(t).withColumn("task", F.spark_partition_id()).where("split = 'train'").groupBy("task").count().collect()
    assert len(tasks) == min(4, spark.sparkContext.defaultParallelism) and sum(r["count"] for r in tasks) == 3000
    assert max(r["count"] for r in tasks) < 1.5 * min(r["count"] for r in tasks)
    assert ML.spread(t.limit(900)).rdd.getNumPartitions() == 1


def test_tuning_of_few_rows_takes_one_task_a_fit_and_all_cores(spark, monkeypatch):
    seen = []

    class Search:
        def __init__(self, parallelism, **more):
            self.parallelism = parallelism

        def fit(self, train):
            seen.append((train.count(), train.rdd.getNumPartitions(), self.parallelism))
    monkeypatch.setattr(ML, "CrossValidator", Search)
    train = spark.createDataFrame([(i, i % 2, Vectors.dense(float(i))) for i in range(40)], [ML.KEY, ML.LABEL, "features"]).repartition(8)
    ML.tune_best("logistic_regression", train, tune_rows=1000)
    assert seen == [(40, 1, spark.sparkContext.defaultParallelism)]
