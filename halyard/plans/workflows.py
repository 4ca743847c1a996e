"""Composite jobs and the remaining source/sink queries (2.1).

Workflows compose the distributed jobs above on the driver; a failed step
is recorded with its error and the other steps still run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halyard.operators import allocation as A
from halyard.operators import customer as C
from halyard.operators import ml as ML
from halyard.operators import scheduling as SC
from halyard.plans import q_allocation as QA
from halyard.plans import q_customer as QC
from halyard.plans import q_ml as QM
from halyard.plans import q_scheduling as QS
from halyard.plans.registry import R, register, round_doubles
from halyard.session import cut_lineage, scratch_path
from halyard.sources import fixtures as X
from halyard.sources.ingest import ingest_json, reuse_or_rebuild, write_processed

SRC = QC.SRC

TELEMETRY_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()), T.StructField("cpu_usage", T.DoubleType()),
    T.StructField("memory_usage", T.DoubleType()), T.StructField("gpu_usage", T.DoubleType()),
    T.StructField("job_queue_length", T.LongType()), T.StructField("active_jobs", T.LongType()),
    T.StructField("cluster_size", T.IntegerType()),
])
# Request bodies are built from the hourly telemetry; two hours of the day are
# deliberately damaged (a mistyped field, a cut-off document) to exercise rejects.
MISTYPED_HOUR, TRUNCATED_HOUR = 13, 7


def telemetry_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON request line per hourly telemetry row."""
    h = X.workload_hourly(spark, sf_dir).withColumnRenamed("timestamp_h", "timestamp")
    body = F.to_json(F.struct(*[F.col(f.name) for f in TELEMETRY_SCHEMA.fields]))
    hour = F.hour("timestamp")
    mistyped = F.regexp_replace(body, '"cpu_usage":[^,]*', '"cpu_usage":"high"')
    truncated = F.substring(body, 1, 40)
    return h.select(F.when(hour == MISTYPED_HOUR, mistyped).when(hour == TRUNCATED_HOUR, truncated)
                    .otherwise(body).alias("value"))


@register("ingest_requests_json", f"""
SELECT timestamp_h AS timestamp, cpu_usage, memory_usage, gpu_usage, job_queue_length, active_jobs, cluster_size
FROM workload_hourly WHERE hour(timestamp_h) NOT IN ({MISTYPED_HOUR}, {TRUNCATED_HOUR})""", fixtures=("workload_hourly",))
def q_ingest_requests_json(spark, sf):
    good, _rejects = ingest_json(telemetry_requests(spark, sf), TELEMETRY_SCHEMA)
    return good


@register("ingest_rejects", f"""
SELECT COUNT(*) AS n_rejected FROM workload_hourly WHERE hour(timestamp_h) IN ({MISTYPED_HOUR}, {TRUNCATED_HOUR})""",
          fixtures=("workload_hourly",))
def q_ingest_rejects(spark, sf):
    _good, rejects = ingest_json(telemetry_requests(spark, sf), TELEMETRY_SCHEMA)
    return rejects.agg(F.count(F.lit(1)).alias("n_rejected"))


_C360_SQL = QC._with_merged(f"SELECT {QC._MERGED_OUT} FROM merged")


@register("write_processed", _C360_SQL, fixtures=SRC)
def q_write_processed(spark, sf):
    path = write_processed(QC.merged(spark, sf), scratch_path(spark, "processed"))
    return round_doubles(spark.read.parquet(path), overrides={"total_transaction_amount": 2})


@register("reuse_or_rebuild", _C360_SQL, fixtures=SRC)
def q_reuse_or_rebuild(spark, sf):
    path = scratch_path(spark, "processed")
    first = reuse_or_rebuild(spark, path, lambda: QC.merged(spark, sf))   # builds and writes
    again = reuse_or_rebuild(spark, path, lambda: QC.merged(spark, sf))   # reads the written table
    assert first.columns == again.columns
    return round_doubles(again, overrides={"total_transaction_amount": 2})


@register("require_source", f"SELECT customer_id, age, gender, tenure_months, contract_type, payment_method, internet_service, "
          f"{R('monthly_charges')} AS monthly_charges, {R('total_charges')} AS total_charges, churn FROM customer_demographics",
          fixtures=SRC)
def q_require_source(spark, sf):
    return round_doubles(C.require_source(QC.sources(spark, sf)))


# ---- workflows ---------------------------------------------------------------------------------

STATUS_SCHEMA = "step string, status string, n_rows long, detail string"


def _step(name, fn):
    try:
        df = fn()
        return (name, "success", int(df.count()), None), df
    except Exception as exc:  # noqa: BLE001 - a failed step is reported, the workflow goes on
        return (name, "failed", None, str(exc)[:500]), None


def workflow_churn(spark: SparkSession, sf: str):
    """data -> features -> train -> tune -> evaluate; returns (status table, outputs).

    The leaderboard winner is tuned over its whole grid on all training rows, and the tuned model, fitted on them, is evaluated.
    """
    outs, rows, held = {}, [], {}

    def tune():
        held["name"] = QM._winner(outs["leaderboard"])
        held["cv"], points = QM._tune(spark, outs["features"], held["name"])
        return points

    def evaluate():
        feats = outs["features"]
        model = ML.fit_tuned(held["name"], held["cv"], feats.where("split = 'train'"))
        res = ML.evaluate_holdout(model, feats.where("split = 'test'"))
        return round_doubles(res["report"].crossJoin(res["auc"].select("auc")))
    for name, out, fn in [
            ("data", "data", lambda: QC.merged(spark, sf)),
            ("features", "features", lambda: QM._features(spark, sf)[1]),
            ("train", "leaderboard", lambda: cut_lineage(ML.model_leaderboard(spark, outs["features"]).leaderboard)),
            ("tune", "tuning", tune),
            ("evaluate", "evaluation", evaluate)]:
        r, outs[out] = _step(name, fn)
        rows.append(r)
    return spark.createDataFrame(rows, STATUS_SCHEMA), outs


def _forecast(spark, sf, model_type):
    feats = QM.workload_features(spark, sf)
    wm = ML.train_workload_model(feats, "timestamp_h", model_type, ML.FORECAST_TARGETS)
    return ML.forecast_workload(wm, feats, "timestamp_h", 24)


def workflow_full_optimization(spark: SparkSession, sf: str, objective: str = "balanced",
                               policy: str = "fair_share", model_type: str = "ridge"):
    """forecast + placement + schedule; each step reported separately."""
    j, n, q = X.jobs(spark, sf), X.nodes(spark, sf), X.user_quotas(spark, sf)
    outs, rows = {}, []
    r, outs["prediction"] = _step("prediction", lambda: _forecast(spark, sf, model_type))
    rows.append(r)
    r, outs["optimization"] = _step("optimization", lambda: A.optimize(j, n, objective))
    rows.append(r)
    r, outs["scheduling"] = _step("scheduling", lambda: SC.schedule(j, n, q, policy)[0])
    rows.append(r)
    return spark.createDataFrame(rows, STATUS_SCHEMA), outs


def workflow_forecast_schedule(spark: SparkSession, sf: str, policy: str = "fair_share", model_type: str = "ridge"):
    j, n, q = X.jobs(spark, sf), X.nodes(spark, sf), X.user_quotas(spark, sf)
    outs, rows = {}, []
    r, outs["prediction"] = _step("prediction", lambda: _forecast(spark, sf, model_type))
    rows.append(r)
    r, outs["scheduling"] = _step("scheduling", lambda: SC.schedule(j, n, q, policy)[0])
    rows.append(r)
    return spark.createDataFrame(rows, STATUS_SCHEMA), outs


@register("workflow_churn")
def q_workflow_churn(spark, sf):
    return workflow_churn(spark, sf)[0].select("step", "status", "n_rows")


# Steps that must succeed, with the rows that each gives: a forecast of 24 hours, the placement, the schedule.
_SCHEDULED = QS.schedule_sql("fair_share")
_FORECAST_STEP = "SELECT 'prediction' AS step, 'success' AS status, CAST(24 AS BIGINT) AS n_rows"
_SCHEDULE_STEP = "SELECT 'scheduling', 'success', COUNT(*) FROM s_fair_sched"
_PLACED = """,
allp AS (SELECT *, 'efficiency' AS objective FROM pe_placements UNION ALL SELECT *, 'throughput' FROM pt_placements
         UNION ALL SELECT *, 'power' FROM pp_placements)"""


@register("workflow_full_optimization", QA._ALL_SUMMARIES + _PLACED + QS.BASE_CTES + _SCHEDULED + f"""
{_FORECAST_STEP} UNION ALL SELECT 'optimization', 'success', COUNT(*) FROM allp a JOIN pick k
  ON a.request_id = k.request_id AND a.objective = k.objective UNION ALL {_SCHEDULE_STEP}""", fixtures=QS.FIX)
def q_workflow_full_optimization(spark, sf):
    return workflow_full_optimization(spark, sf)[0].select("step", "status", "n_rows")


@register("workflow_forecast_schedule", QS.BASE_CTES + _SCHEDULED + f"\n{_FORECAST_STEP} UNION ALL {_SCHEDULE_STEP}", fixtures=QS.FIX)
def q_workflow_forecast_schedule(spark, sf):
    return workflow_forecast_schedule(spark, sf)[0].select("step", "status", "n_rows")
