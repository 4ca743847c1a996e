import random

import numpy as np
import pytest

from halyard.operators.customer import join_usage
from halyard.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.01, 0.33, 0.5, 0.67, 0.75, 0.95, 1.0]


def test_equals_linear_interpolation(spark):
    rng = random.Random(1)
    rows = [(g, rng.choice([rng.gauss(0, 1e6), float(rng.randint(0, 5)), 1e-9 * rng.random()])) for g in "ab" for _ in range(700)]
    rows += [("c", 3.5), ("b", None), ("d", 1.0), ("d", 2.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r for r in exact_quantiles(df, "v", PROBS, by=["g"], buckets=16).collect()}
    for g in "abcd":
        want = np.quantile([v for k, v in rows if k == g and v is not None], PROBS)
        assert np.allclose(list(got[g])[1:], want, rtol=1e-12, atol=0)
    whole = exact_quantiles(df, "v", PROBS).first()
    assert np.allclose(list(whole), np.quantile([v for _, v in rows if v is not None], PROBS), rtol=1e-12, atol=0)
    assert exact_quantiles(df.limit(0), "v", [0.5]).first()["q_50"] is None


def test_plan_holds_no_value_buffer(spark):
    df = spark.range(10).selectExpr("cast(id as double) v")
    plan = exact_quantiles(df, "v", [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "percentile(" not in plan


def test_repeated_usage_key_is_refused(spark):
    base = spark.createDataFrame([(1,), (2,), (3,)], "customer_id long")
    usage = spark.createDataFrame([(1, 5.0), (2, None)], "customer_id long, gb double")
    assert sorted(map(tuple, join_usage(base, usage).collect())) == [(1, 5.0), (2, None), (3, None)]
    with pytest.raises(Exception, match="not unique"):
        join_usage(base, usage.union(usage)).collect()
