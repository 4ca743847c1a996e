"""Column-level functions (all built-in expressions, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's.
# Optional scoring inputs that default to 0 when absent.
OPTIONAL_SCORING_FIELDS = {
    "total_transaction_amount": "double",
    "avg_transaction_amount": "double",
    "transaction_count": "bigint",
    "avg_resolution_time": "double",
    "support_ticket_count": "bigint",
    "avg_monthly_usage_gb": "double",
    "streaming_services_used": "int",
}
# Risk thresholds (p < .3 Low, p < .7 Medium, else High) and the decision cut .5.
RISK_LOW, RISK_HIGH, DECISION_CUT = 0.3, 0.7, 0.5
# Path substring -> owning service, first match wins; else "gateway".
SERVICE_ROUTES = [("predict", "workload-predictor"), ("optimize", "resource-optimizer"),
                  ("schedule", "scheduler-optimizer")]
HIGH_PRIORITY = 7


def default_optional_fields(df: DataFrame) -> DataFrame:
    """Absent or NULL optional numeric inputs become 0."""
    out = df
    for name, typ in OPTIONAL_SCORING_FIELDS.items():
        src = F.col(name) if name in df.columns else F.lit(None)
        out = out.withColumn(name, F.coalesce(src.cast(typ), F.lit(0).cast(typ)))
    return out


def risk_level(p: Column) -> Column:
    return F.when(p < RISK_LOW, "Low").when(p < RISK_HIGH, "Medium").otherwise("High")


def churn_decision(df: DataFrame, prob: str = "churn_probability") -> DataFrame:
    p = F.col(prob)
    return df.select(
        *[c for c in df.columns if c != prob],
        F.round(p, 4).alias(prob),
        (p > DECISION_CUT).alias("churn_prediction"),
        risk_level(p).alias("risk_level"),
        F.round(F.abs(p - DECISION_CUT) * 2, 4).alias("confidence"),
    )


def service_from_path(path: Column) -> Column:
    expr = None
    for needle, service in SERVICE_ROUTES:
        cond = F.instr(path, needle) > 0
        expr = F.when(cond, service) if expr is None else expr.when(cond, service)
    return expr.otherwise("gateway")


def error_flag(status: Column) -> Column:
    return status >= 400


def clamp_unit(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def clamp_count(x: Column) -> Column:
    """max(0, int(x)): truncation toward zero, then floor at 0."""
    return F.greatest(F.lit(0), F.when(x < 0, F.ceil(x)).otherwise(F.floor(x)).cast("bigint"))


def priority_class(priority: Column) -> Column:
    return F.when(priority >= HIGH_PRIORITY, "priority").otherwise("regular")


def calendar_features(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """hour, day of week (Mon=0), month, weekend flag."""
    t = F.col(ts)
    return (df.withColumn("hour", F.hour(t)).withColumn("day_of_week", F.weekday(t))
            .withColumn("month", F.month(t))
            .withColumn("is_weekend", (F.weekday(t) >= 5).cast("int")))


def interaction_features(df: DataFrame) -> DataFrame:
    out = df
    if "cpu_usage" in df.columns and "memory_usage" in df.columns:
        out = (out.withColumn("cpu_memory_ratio", F.col("cpu_usage") / (F.col("memory_usage") + 1e-8))
               .withColumn("cpu_memory_product", F.col("cpu_usage") * F.col("memory_usage")))
    if "job_queue_length" in df.columns and "active_jobs" in df.columns:
        out = (out.withColumn("queue_active_ratio", F.col("job_queue_length") / (F.col("active_jobs") + 1))
               .withColumn("total_jobs", F.col("job_queue_length") + F.col("active_jobs")))
    return out


def add_hours(ts: Column, hours: Column) -> Column:
    """ts + hours (fractional hours kept to the microsecond)."""
    return F.timestamp_add("MICROSECOND", F.round(hours * 3600 * 1000000).cast("bigint"), ts)


def add_minutes(ts: Column, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes.cast("bigint"), ts)
