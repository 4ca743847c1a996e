"""Hand fixtures and invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from halyard.operators import allocation as A
from halyard.operators import customer as C
from halyard.operators import gateway as G
from halyard.operators import ml as ML
from halyard.operators import scheduling as SC
from halyard.operators import timeseries as TS
from halyard.operators.prefix import running_totals
from halyard.sources import fixtures as X

T0 = dt.datetime(2024, 1, 1)


def test_age_group_edges(spark):
    df = spark.createDataFrame([(a,) for a in [0, 30, 31, 50, 70, 100, 101]], "age int")
    got = [r.age_group for r in C.age_group(df).orderBy("age").collect()]
    assert got == ["nan", "Young", "Middle", "Middle", "Senior", "Elder", "nan"]


def _series(spark, n, newest_first=False):
    rows = [(T0 + dt.timedelta(hours=i), 0.5 + 0.01 * i, 0.3 + 0.02 * i, 10 + i, 5 + i) for i in range(n)]
    if newest_first:
        rows.reverse()
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, cpu_usage double, memory_usage double, "
                                       "job_queue_length long, active_jobs long")


def test_full_window_guard(spark):
    assert TS.timeseries_features(_series(spark, 24), "timestamp").count() == 0
    out = TS.timeseries_features(_series(spark, 25, newest_first=True), "timestamp").collect()
    assert len(out) == 1
    r = out[0]
    assert r.cpu_usage_lag_24 == pytest.approx(0.5)
    assert r.cpu_usage_trend_24 == pytest.approx(0.01)      # straight line: exact slope
    assert r.memory_usage_trend_6 == pytest.approx(0.02)
    assert r.cpu_usage_rolling_std_3 == pytest.approx(0.01)  # sample std of 3 equally spaced points


def test_blocked_windows_equal_unblocked(spark, sf):
    h = X.workload_hourly(spark, sf)
    a = TS.timeseries_features(h, "timestamp_h", block_rows=50).orderBy("timestamp_h").collect()
    b = TS.timeseries_features(h, "timestamp_h").orderBy("timestamp_h").collect()
    assert len(a) == len(b) > 0
    for x, y in zip(a, b):
        for k, v in x.asDict().items():
            w = y[k]
            assert (v == pytest.approx(w, rel=1e-9, abs=1e-12)) if isinstance(v, float) else v == w, k


def test_running_totals_equal_window(spark):
    df = spark.range(0, 5000).select(F.col("id"), (F.col("id") % 3).alias("g"), ((F.col("id") * 7) % 11).alias("v"))
    got = running_totals(df, ["g"], [F.col("v").asc(), F.col("id").asc()], ["v"], rank_col="rk", parts=7)
    w = Window.partitionBy("g").orderBy("v", "id")
    exp = df.select("id", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("e"),
                    F.row_number().over(w).alias("er"))
    bad = got.join(exp, "id").where((F.col("cum_v") != F.col("e")) | (F.col("rk") != F.col("er"))).count()
    assert bad == 0


def test_rate_limit_edge(spark):
    # 101 requests inside 59 s, then one at exactly 60 s after the first
    rows = [(i, 1, T0 + dt.timedelta(seconds=i * 59 / 100)) for i in range(101)] + [(101, 1, T0 + dt.timedelta(seconds=60))]
    df = spark.createDataFrame(rows, "request_id long, client_id long, ts timestamp_ntz")
    out = {r.request_id: r.rejected for r in G.rate_limit_flags(df, limit=100, window_seconds=60).collect()}
    assert not any(out[i] for i in range(100))
    assert out[100]            # 101st inside the window
    assert out[101]            # offered load: 100 earlier requests still inside (ts - 60 s, ts]


def test_stream_rate_limit_matches_brute_force(spark, sf):
    from halyard.streaming.gateway import stream_rate_limit
    from halyard.streaming.runner import stream_table
    limit, win = 3, 6 * 3600
    got = {r.request_id: r.rejected for r in stream_rate_limit(stream_table(spark, sf, "events"), spark, limit, win).collect()}
    reqs = X.gateway_requests(spark, sf).select("request_id", "client_id", "ts").collect()
    by = {}
    for r in sorted(reqs, key=lambda r: (r.client_id, r.ts, r.request_id)):
        by.setdefault(r.client_id, []).append(r)
    expect = {}
    for rs in by.values():
        acc = []
        for r in rs:
            acc = [a for a in acc if (r.ts - a).total_seconds() < win]
            if len(acc) >= limit:
                expect[r.request_id] = True
            else:
                acc.append(r.ts)
                expect[r.request_id] = False
    assert got == expect


def test_equal_nodes_lowest_ordinal(spark):
    jobs = spark.createDataFrame([("j1", 1, 0, 5, 60, 4, 8.0, 0, 100.0, 1.0)],
                                 "job_id string, job_ordinal long, request_id long, priority int, "
                                 "estimated_runtime_minutes int, cpu_cores_required int, memory_gb_required double, "
                                 "gpu_count_required int, power_watts_estimated double, network_bandwidth_gbps double")
    node = ("64, 48, 256.0, 192.0, 2, 2, 4000.0, 40.0, 0.7, true")
    nodes = spark.sql(f"SELECT * FROM VALUES ('n-b', 7, 0, {node}), ('n-a', 3, 0, {node}) AS t(node_id, node_ordinal, "
                      "request_id, total_cpu_cores, available_cpu_cores, total_memory_gb, available_memory_gb, "
                      "total_gpu_count, available_gpu_count, available_power_watts, available_network_bandwidth_gbps, "
                      "node_efficiency_score, is_available)")
    p, _ = A.place(jobs, nodes, "efficiency")
    assert [r.node_id for r in p.collect()] == ["n-a"]


def test_placement_invariants(spark, sf):
    jobs, nodes = X.jobs(spark, sf), X.nodes(spark, sf)
    for objective in A.OBJECTIVES:
        p, _ = A.place(jobs, nodes, objective)
        assert p.groupBy("job_id").count().where("count > 1").count() == 0
        use = A.node_usage(p).join(nodes, ["request_id", "node_id"])
        over = use.where((F.col("used_cpu") > F.col("available_cpu_cores"))
                         | (F.col("used_memory") > F.col("available_memory_gb"))
                         | (F.col("used_gpu") > F.col("available_gpu_count"))
                         | (F.col("used_power") > F.col("available_power_watts"))
                         | (F.col("used_bandwidth") > F.col("available_network_bandwidth_gbps")))
        assert over.count() == 0
        assert p.count() + A.unplaced_jobs(jobs, p).count() == jobs.count()


def test_quota_edge_equal_limit_passes(spark):
    jobs = spark.createDataFrame(
        [(f"j{i}", i, 0, 1, 5, 30, 4, 8.0, 0, T0 + dt.timedelta(minutes=i)) for i in range(3)],
        "job_id string, job_ordinal long, request_id long, user_id long, priority int, estimated_runtime_minutes int, "
        "cpu_cores_required int, memory_gb_required double, gpu_count_required int, submission_time timestamp_ntz")
    quotas = spark.createDataFrame([(1, 1, 12, 24.0, 3)], "user_id long, user_priority int, max_cpu_cores int, "
                                                           "max_memory_gb double, max_concurrent_jobs int")
    fair = SC.with_fair_key(SC.scheduler_jobs(jobs), quotas)
    assert SC.quota_admission(fair).count() == 3          # sums equal the limits exactly
    tight = quotas.withColumn("max_concurrent_jobs", F.lit(2))
    assert SC.quota_admission(SC.with_fair_key(SC.scheduler_jobs(jobs), tight)).count() == 2


def test_quotas_skip_and_go_on(spark, sf):
    """The set-based admission equals one job at a time: skip what does not fit, go on."""
    jobs, quotas = X.jobs(spark, sf), X.user_quotas(spark, sf)
    fair = SC.with_fair_key(SC.scheduler_jobs(jobs), quotas)
    got = {r.job_id for r in SC.quota_admission(fair).collect()}
    used, want = {}, set()
    for r in fair.orderBy(*SC.queue_order("fair_share")).collect():
        u = used.setdefault((r.request_id, r.user_id), [0, 0.0, 0])
        if r.max_concurrent_jobs is None or (u[0] + r.cpu_cores_required <= r.max_cpu_cores and u[1] + r.memory_gb_required <= r.max_memory_gb
                                             and u[2] + 1 <= r.max_concurrent_jobs):
            want.add(r.job_id)
            u[0], u[1], u[2] = u[0] + r.cpu_cores_required, u[1] + r.memory_gb_required, u[2] + 1
    assert got == want


def test_fair_share_respects_quotas_and_fills_nodes(spark, sf):
    jobs, nodes, quotas = X.jobs(spark, sf), X.nodes(spark, sf), X.user_quotas(spark, sf)
    out, j, state = SC.schedule(jobs, nodes, quotas, "fair_share")
    mine = out.join(j.select("request_id", "job_id", "user_id"), ["request_id", "job_id"])
    taken = mine.groupBy("user_id", "request_id").agg(F.sum("allocated_cpu_cores").alias("c"), F.sum("allocated_memory_gb").alias("m"),
                                                      F.count(F.lit(1)).alias("n")).join(quotas, "user_id")
    assert taken.where("c > max_cpu_cores or m > max_memory_gb or n > max_concurrent_jobs").count() == 0
    full, _, end = SC.schedule(jobs, nodes, quotas, "fifo")
    from halyard.operators.placement import still_fitting
    assert still_fitting(SC.scheduler_jobs(jobs), full, end, SC.DIMS, SC.available_expr()).count() == 0


def test_timeline_is_sequential_per_node(spark, sf):
    out, jobs, _ = SC.schedule(X.jobs(spark, sf), X.nodes(spark, sf), X.user_quotas(spark, sf), "fifo")
    rows = out.orderBy("node_id", "queue_position").collect()
    prev = {}
    for r in rows:
        if r.node_id in prev:
            assert r.scheduled_start_time == prev[r.node_id]
        prev[r.node_id] = r.estimated_completion_time


def test_stratified_split_proportions(spark, sf):
    s = ML.stratified_split(X.customer_demographics(spark, sf).select("customer_id", "churn"))
    counts = {(r.churn, r.split): r["count"] for r in s.groupBy("churn", "split").count().collect()}
    for c in (0, 1):
        n = sum(v for (cc, _), v in counts.items() if cc == c)
        assert abs(counts[(c, "test")] - 0.2 * n) <= 1
        assert abs(counts[(c, "validation")] - 0.2 * n) <= 1.5


def test_require_source_raises():
    with pytest.raises(ValueError):
        C.require_source({"transaction_history": None})


def test_forecast_horizon_and_bounds(spark, sf):
    from halyard.plans.q_ml import workload_features
    feats = workload_features(spark, sf)
    wm = ML.train_workload_model(feats, "timestamp_h", "ridge")
    fc = ML.forecast_workload(wm, feats, "timestamp_h", 12).collect()
    assert len(fc) == 12
    for r in fc:
        assert 0 <= r.cpu_usage <= 1 and 0 <= r.memory_usage <= 1 and r.job_queue_length >= 0


def test_forecast_of_all_targets_and_of_the_chosen_regressor(spark, sf):
    from halyard.plans.q_ml import workload_features
    feats = workload_features(spark, sf)
    ranked = ML.auto_select_regressor(feats, "timestamp_h", ["cpu_usage"], names=["ridge", "linear"])
    best = ranked.orderBy(F.col("cv_r2").desc(), "model").first()["model"]
    real, ML.AUTO_SELECT_CANDIDATES = ML.AUTO_SELECT_CANDIDATES, ["ridge", "linear"]
    try:
        wm = ML.train_workload_model(feats, "timestamp_h", "auto", ["cpu_usage"])
    finally:
        ML.AUTO_SELECT_CANDIDATES = real
    assert wm.model_type == best
    for r in ML.forecast_workload(wm, feats, "timestamp_h", 3).collect():
        assert 0 <= r.lower <= r.cpu_usage <= r.upper <= 1 and r.memory_usage is None and r.model_version.startswith(best)
    other = ML.train_workload_model(feats, "timestamp_h", "ridge", ["job_queue_length"])
    row = ML.forecast_workload(other, feats, "timestamp_h", 1).first()
    assert row.cpu_usage is None and row.lower is None and row.job_queue_length >= 0


def test_ingest_rejects_bad_rows(spark, sf):
    from halyard.plans.workflows import TELEMETRY_SCHEMA, telemetry_requests
    from halyard.sources.ingest import ingest_json
    lines = telemetry_requests(spark, sf)
    good, bad = ingest_json(lines, TELEMETRY_SCHEMA)
    assert good.count() + bad.count() == lines.count()
    assert bad.count() > 0


def test_workflow_steps_succeed(spark, sf):
    from halyard.plans.workflows import workflow_forecast_schedule
    status, _ = workflow_forecast_schedule(spark, sf)
    assert {r.step: r.status for r in status.collect()} == {"prediction": "success", "scheduling": "success"}


def test_best_node_per_vector_equals_all_pairs(spark, sf):
    """Pairing distinct demand vectors gives every job the node that all job x node pairs give it."""
    jobs, nodes = A.allocation_jobs(X.jobs(spark, sf)).collect(), X.nodes(spark, sf).collect()
    got = {r.job_id: (r.node_id, r.score) for r in A.first_choice(X.jobs(spark, sf), X.nodes(spark, sf)).collect()}
    want = {}
    for j in jobs:
        fits = [n for n in nodes if n.request_id == j.request_id and all(n[d.capacity] >= j[d.demand] for d in A.DIMS)]
        if fits:
            def score(n):
                balance = 1.0 - abs(j.cpu_cores_required / n.available_cpu_cores - j.memory_gb_required / n.available_memory_gb)
                return balance * .4 + n.node_efficiency_score * .4 + j.priority / 10.0 * .2
            best = min(fits, key=lambda n: (-(score(n) - j.priority / 10.0 * .2), n.node_ordinal))
            want[j.job_id] = (best.node_id, score(best))
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-12 for k in want)


def test_load_sources_skips_missing(spark, sf, tmp_path):
    from halyard.sources.ingest import load_sources
    got = load_sources(spark, {"customer": f"{sf}/customer.parquet", "nope": str(tmp_path / "missing.parquet")})
    assert set(got) == {"customer"}


def test_rate_limit_blocks_match_brute_force(spark, sf):
    reqs = X.gateway_requests(spark, sf)
    win = 300
    got = {r.request_id: r.prior_in_window for r in G.rate_limit_flags(reqs, limit=1, window_seconds=win).collect()}
    rows = sorted(reqs.select("request_id", "client_id", "ts").collect(), key=lambda r: (r.client_id, r.ts, r.request_id))
    expect = {}
    for r in rows:
        expect[r.request_id] = sum(1 for o in rows if o.client_id == r.client_id
                                   and ((o.ts < r.ts and (r.ts - o.ts).total_seconds() < win)
                                        or (o.ts == r.ts and o.request_id < r.request_id)))
    assert got == expect


def test_running_max_plus_matches_sequential(spark):
    from halyard.operators.prefix import running_max_plus
    rows = [(i, i % 2, 10 + (i * 7) % 13, (i * 37) % 500) for i in range(3000)]  # id, group, duration, release
    df = spark.createDataFrame(rows, "id long, g long, d long, r long")
    got = {r.id: (r._end, r._rank) for r in running_max_plus(df, ["g"], [F.col("id").asc()], "d", "r", parts=7).collect()}
    expect = {}
    for g in (0, 1):
        end, rank = None, 0
        for i, gg, d, r in rows:
            if gg != g:
                continue
            start = r if end is None else max(r, end)
            end, rank = start + d, rank + 1
            expect[i] = (end, rank)
    assert got == expect
