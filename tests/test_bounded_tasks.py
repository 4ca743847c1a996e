"""Operators whose groups or value lists may be very large: dictionaries, quotas, rolling functions."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from halyard.functions.udf import polyfit_slope, rolling_apply
from halyard.operators import dictionary as D
from halyard.operators import ml as ML
from halyard.operators import scheduling as SC

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture
def tables(monkeypatch):
    """Names of the tables that operators write."""
    import halyard.operators.prefix as prefix
    written = []
    for module in (prefix, SC, D):
        real = module.cut_lineage

        def counted(df, name="stage", real=real):
            written.append(name)
            return real(df, name)
        monkeypatch.setattr(module, "cut_lineage", counted)
    return written


def test_dictionary_of_millions_of_values(spark, tables):
    n = 5_000_000
    df = spark.range(n).select(F.concat(F.lit("v"), F.lpad(F.reverse(F.col("id").cast("string")), 8, "0")).alias("a"),
                               (F.col("id") % 3).cast("string").alias("b"))
    words = D.dictionary(df, ["a", "b"])
    assert D.sizes(words) == {"a": df.select("a").distinct().count(), "b": 3}
    assert words.where("column = 'b'").orderBy("index").select("value", "index").collect() == [("0", 0.0), ("1", 1.0), ("2", 2.0)]
    a = words.where("column = 'a'")
    steps = a.agg(F.min("index"), F.max("index"), F.count_distinct("index")).first()
    assert tuple(steps) == (0.0, a.count() - 1.0, a.count())
    pair = a.alias("x").join(a.alias("y"), F.col("y.index") == F.col("x.index") + 1).where("x.value >= y.value")
    assert pair.count() == 0 and len(tables) <= 3


def test_unseen_and_missing_values(spark):
    seen = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    words = D.dictionary(seen, ["c"])
    new = spark.createDataFrame([("a",), ("zz",), (None,), ("",)], "c string")
    got = {r["c"]: r["c_encoded"] for r in D.encode(new, words, ["c"]).collect()}
    assert got == {"a": 1.0, None: 0.0, "zz": 3.0, "": 3.0}  # a missing value is "0", an unseen one the last index
    table, again = ML.label_encode(new, ["c"], words)
    assert table.columns == ["c_encoded"] and again is words
    assert D.encode(new.limit(0), D.dictionary(seen.limit(0), ["c"]), ["c"]).count() == 0


def sequential(rows, limits):
    used, out = {}, set()
    for r in rows:
        u = used.setdefault((r["request_id"], r["user_id"]), [0, 0.0, 0])
        after = [u[0] + r["cpu_cores_required"], u[1] + r["memory_gb_required"], u[2] + 1]
        if all(x is None or a <= x for a, x in zip(after, limits.get(r["user_id"], (None,) * 3))):
            out.add(r["job_id"])
            used[r["request_id"], r["user_id"]] = after
    return out


@pytest.mark.parametrize("short", [False, True])
def test_quota_of_a_user_with_many_skips(spark, tables, monkeypatch, short):
    """10,000 jobs of one user, every second one too large for what is left when it comes."""
    if short:
        monkeypatch.setattr(SC, "ADMIT_BLOCK", 16)
        monkeypatch.setattr(SC, "FIRST_ADMITTED", 700)
    n = 10_000
    rows = [(f"j{i}", i, 0, 1, 5, 30, 1 if i % 2 == 0 else 4_500 - i // 4, 1.0, 0, T0 + dt.timedelta(minutes=i)) for i in range(n)]
    rows += [(f"k{i}", n + i, i % 2, 2 + i % 3, 5, 30, 3, 2.5, 0, T0) for i in range(60)]
    jobs = spark.createDataFrame(rows, "job_id string, job_ordinal long, request_id long, user_id long, priority int, estimated_runtime_minutes int, "
                                       "cpu_cores_required int, memory_gb_required double, gpu_count_required int, submission_time timestamp_ntz")
    limits = {1: (4_500, None, None), 2: (10, 6.0, None), 3: (None, None, 4)}
    quotas = spark.createDataFrame([(u, 1, *x) for u, x in limits.items()], "user_id long, user_priority int, max_cpu_cores int, max_memory_gb double, "
                                                                         "max_concurrent_jobs int")
    fair = SC.with_fair_key(SC.scheduler_jobs(jobs), quotas)
    got = {r["job_id"] for r in SC.quota_admission(fair).collect()}
    order = [r.asDict() for r in fair.orderBy(*SC.queue_order("fair_share")).collect()]
    assert got == sequential(order, limits) and len(tables) <= 20
    assert sum(x.startswith("j") for x in got) == 4_500


def test_rolling_function_runs_once_a_block(spark, tmp_path):
    values = [None if i % 37 == 5 else float((i * 7919) % 101) for i in range(1000)]
    df = spark.createDataFrame([(T0 + dt.timedelta(hours=i), v) for i, v in enumerate(values)], "ts timestamp_ntz, x double")
    folder = str(tmp_path)

    def counted(frames: np.ndarray) -> np.ndarray:
        import uuid
        open(f"{folder}/{uuid.uuid4().hex}", "w").close()
        return polyfit_slope(frames)
    got = [r["x_rolling_fn_6"] for r in rolling_apply(df, "x", 6, counted, "ts", block_rows=100).orderBy("ts").collect()]
    assert 10 <= len(list(tmp_path.iterdir())) <= 11  # one call a block
    for i, g in enumerate(got):
        frame = values[max(0, i - 5):i + 1]
        want = None if len(frame) < 6 or None in frame else np.polyfit(np.arange(6), frame, 1)[0]
        assert (g is None) == (want is None) and (g is None or abs(g - want) < 1e-9)
    whole = [r[0] for r in rolling_apply(df, "x", 6, polyfit_slope, "ts").orderBy("ts").select("x_rolling_fn_6").collect()]
    assert whole == got
