"""Customer 360 table and the derived churn features.

Aggregate-before-join: transactions and tickets are reduced to one row per
customer (partial aggregation map-side, one shuffle on ``customer_id``)
before the left joins, so the joins see at most one row per key on the
right and never fan out.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halyard.operators.quantiles import exact_quantiles

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)

# Fixed values that must equal the reference's (contract risk map, age bins, thresholds).
CONTRACT_RISK = {"Month-to-month": 3, "One year": 2, "Two year": 1}
AGE_BINS = [(0, 30, "Young"), (30, 50, "Middle"), (50, 70, "Senior"), (70, 100, "Elder")]
USAGE_QUANTILES = (0.33, 0.67)
HIGH_VALUE_QUANTILE = 0.75


def txn_agg(transactions: DataFrame) -> DataFrame:
    """Per customer sum, mean, count of amount and latest date."""
    return transactions.groupBy("customer_id").agg(
        F.sum("amount").alias("total_transaction_amount"),
        F.avg("amount").alias("avg_transaction_amount"),
        F.count("amount").alias("transaction_count"),
        F.max("transaction_date").alias("last_transaction_date"),
    )


def ticket_agg(tickets: DataFrame) -> DataFrame:
    """Per customer mean and count of resolution hours."""
    return tickets.groupBy("customer_id").agg(
        F.avg("resolution_time_hours").alias("avg_resolution_time"),
        F.count("resolution_time_hours").alias("support_ticket_count"),
    )


def require_source(sources: Mapping[str, DataFrame], name: str = "customer_demographics") -> DataFrame:
    if sources.get(name) is None:
        raise ValueError(f"{name} data is required")
    return sources[name]


def join_transactions(base: DataFrame, transactions: DataFrame) -> DataFrame:
    return base.join(txn_agg(transactions), "customer_id", "left")


def join_tickets(base: DataFrame, tickets: DataFrame) -> DataFrame:
    return base.join(ticket_agg(tickets), "customer_id", "left")


def join_usage(base: DataFrame, usage: DataFrame) -> DataFrame:
    """Left join of the raw usage table.  Its key must be unique: a repeated one would fan the base out, so
    the plan fails on it when it runs."""
    value = F.struct(*[c for c in usage.columns if c != "customer_id"])
    one = usage.groupBy("customer_id").agg(F.first(value).alias("_u"), F.count(F.lit(1)).alias("_rows"))
    checked = F.when(F.col("_rows") > 1, F.raise_error(F.concat(F.lit("product usage: customer_id is not unique: "), F.col("customer_id").cast("string")))
                     .cast(one.schema["_u"].dataType)).otherwise(F.col("_u"))
    return base.join(one.select("customer_id", checked.alias("_u")).select("customer_id", "_u.*"), "customer_id", "left")


def fill_missing(df: DataFrame) -> DataFrame:
    """NULL -> 0 for numeric columns, '0' for strings; dates stay NULL."""
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]
    txt = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    out = df.na.fill(0, subset=num) if num else df
    return out.na.fill("0", subset=txt) if txt else out


def merge_sources(sources: Mapping[str, DataFrame], fill: bool = True) -> DataFrame:
    """customer_360: demographics + transaction / ticket aggregates + usage."""
    merged = require_source(sources)
    if sources.get("transaction_history") is not None:
        merged = join_transactions(merged, sources["transaction_history"])
    if sources.get("support_tickets") is not None:
        merged = join_tickets(merged, sources["support_tickets"])
    if sources.get("product_usage") is not None:
        merged = join_usage(merged, sources["product_usage"])
    return fill_missing(merged) if fill else merged


def customer_360(demographics: DataFrame, transactions: DataFrame | None = None,
                 tickets: DataFrame | None = None, usage: DataFrame | None = None,
                 fill: bool = True) -> DataFrame:
    return merge_sources({"customer_demographics": demographics, "transaction_history": transactions,
                          "support_tickets": tickets, "product_usage": usage}, fill=fill)


# ---- derived features -------------------------------------------------------

def charges_ratio(df: DataFrame) -> DataFrame:
    return df.withColumn("charges_per_month_ratio", F.col("total_charges") / (F.col("tenure_months") + 1))


def tickets_per_month(df: DataFrame) -> DataFrame:
    cnt = F.col("support_ticket_count") if "support_ticket_count" in df.columns else F.lit(0)
    return df.withColumn("support_tickets_per_month", cnt / (F.col("tenure_months") + 1))


def estimated_clv(df: DataFrame) -> DataFrame:
    return df.withColumn("estimated_clv", F.col("monthly_charges") * F.col("tenure_months"))


def contract_risk_expr(col: Column) -> Column:
    expr = None
    for name, score in CONTRACT_RISK.items():
        expr = F.when(col == name, score) if expr is None else expr.when(col == name, score)
    return expr


def contract_risk(df: DataFrame) -> DataFrame:
    return df.withColumn("contract_risk_score", contract_risk_expr(F.col("contract_type")))


def age_group_expr(col: Column) -> Column:
    """Right-closed bins; outside (0, 100] (and NULL) is the string 'nan'."""
    expr = None
    for lo, hi, name in AGE_BINS:
        cond = (col > lo) & (col <= hi)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise("nan")


def age_group(df: DataFrame) -> DataFrame:
    return df.withColumn("age_group", age_group_expr(F.col("age")))


def global_quantiles(df: DataFrame, col: str, probs) -> DataFrame:
    """One-row table ``q_<p>`` of exact global quantiles (linear interpolation)."""
    return exact_quantiles(df, col, probs)


def usage_trend(df: DataFrame) -> DataFrame:
    """Low / Medium / High by the global .33 / .67 quantiles (right-closed)."""
    if "avg_monthly_usage_gb" not in df.columns:
        return df.withColumn("usage_trend", F.lit("Unknown"))
    q = global_quantiles(df, "avg_monthly_usage_gb", USAGE_QUANTILES)
    v = F.col("avg_monthly_usage_gb")
    trend = (F.when(v.isNull(), "nan").when(v <= F.col("q_33"), "Low")
             .when(v <= F.col("q_67"), "Medium").otherwise("High"))
    # one-row side: broadcast is bounded by construction
    return df.crossJoin(F.broadcast(q)).withColumn("usage_trend", trend).drop("q_33", "q_67")


def high_value_flag(df: DataFrame) -> DataFrame:
    q = global_quantiles(df, "monthly_charges", [HIGH_VALUE_QUANTILE])
    return (df.crossJoin(F.broadcast(q))
            .withColumn("high_value_customer", (F.col("monthly_charges") > F.col("q_75")).cast("int"))
            .drop("q_75"))


def derived_features(df: DataFrame) -> DataFrame:
    """All derived churn features in the reference's order."""
    out = tickets_per_month(charges_ratio(df))
    out = usage_trend(out)
    out = contract_risk(estimated_clv(out))
    out = age_group(out)
    return high_value_flag(out)


def target_distribution(df: DataFrame, label: str = "churn") -> DataFrame:
    """Class counts with the overall rate on every row."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))
    total = df.agg(F.count(F.lit(1)).alias("n_total"), F.avg(label).alias("churn_rate"))
    return counts.crossJoin(F.broadcast(total))


def split_target(df: DataFrame, label: str = "churn"):
    """(features, label) projections of the same table."""
    return df.drop(label), df.select(label)
