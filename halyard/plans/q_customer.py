"""Customer 360 / derived feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from halyard.operators import customer as C
from halyard.plans.registry import R, register, round_doubles
from halyard.sources import fixtures as X

SRC = ("customer_demographics", "transactions", "support_tickets", "product_usage")

_TXN_SQL = """t AS (SELECT customer_id, SUM(amount) AS total_transaction_amount, AVG(amount) AS avg_transaction_amount,
                      COUNT(amount) AS transaction_count, MAX(transaction_date) AS last_transaction_date
               FROM transactions GROUP BY customer_id)"""
_TKT_SQL = """s AS (SELECT customer_id, AVG(resolution_time_hours) AS avg_resolution_time,
                      COUNT(resolution_time_hours) AS support_ticket_count
               FROM support_tickets GROUP BY customer_id)"""

_DEMO_COLS = ("d.customer_id, d.age, d.gender, d.tenure_months, d.contract_type, d.payment_method, "
              f"d.internet_service, {R("d.monthly_charges", 6)} AS monthly_charges, "
              f"{R("d.total_charges", 6)} AS total_charges, d.churn")

# merged table (SQL twin of customer_360) used by several oracle queries
MERGED_SQL = f""", {_TXN_SQL}, {_TKT_SQL},
merged AS (
  SELECT d.*, COALESCE(t.total_transaction_amount, 0) AS total_transaction_amount,
         COALESCE(t.avg_transaction_amount, 0) AS avg_transaction_amount,
         COALESCE(t.transaction_count, 0) AS transaction_count, t.last_transaction_date,
         COALESCE(s.avg_resolution_time, 0) AS avg_resolution_time,
         COALESCE(s.support_ticket_count, 0) AS support_ticket_count,
         COALESCE(u.avg_monthly_usage_gb, 0) AS avg_monthly_usage_gb,
         COALESCE(u.peak_usage_hours, '0') AS peak_usage_hours,
         COALESCE(u.streaming_services_used, 0) AS streaming_services_used
  FROM customer_demographics d
  LEFT JOIN t ON d.customer_id = t.customer_id
  LEFT JOIN s ON d.customer_id = s.customer_id
  LEFT JOIN product_usage u ON d.customer_id = u.customer_id)
"""


def sources(spark, sf):
    return {"customer_demographics": X.customer_demographics(spark, sf),
            "transaction_history": X.transactions(spark, sf),
            "support_tickets": X.support_tickets(spark, sf),
            "product_usage": X.product_usage(spark, sf)}


def merged(spark, sf, fill=True):
    return C.merge_sources(sources(spark, sf), fill=fill)


def _with_merged(select: str) -> str:
    return MERGED_SQL + select


# ---- sources ---------------------------------------------------------------

@register("load_sources", """
SELECT 'customer_demographics' AS source, COUNT(*) AS n_rows FROM customer_demographics
UNION ALL SELECT 'transaction_history', COUNT(*) FROM transactions
UNION ALL SELECT 'support_tickets', COUNT(*) FROM support_tickets
UNION ALL SELECT 'product_usage', COUNT(*) FROM product_usage""", fixtures=SRC)
def q_load_sources(spark, sf):
    """Read the configured source files, one of which is missing, and count them."""
    from halyard.session import scratch_path
    from halyard.sources.ingest import load_sources, load_summary_table, write_processed
    base = scratch_path(spark, "sources")
    paths = {name: write_processed(df, f"{base}/{name}") for name, df in sources(spark, sf).items()}
    return load_summary_table(load_sources(spark, paths | {"not_configured": f"{base}/not_configured"}))


@register("load_summary", _with_merged(f"""
SELECT 'merged' AS stage, COUNT(*) AS n_rows, {R("AVG(churn)", 6)} AS churn_rate FROM merged
UNION ALL SELECT 'customer_demographics', COUNT(*), {R("AVG(churn)", 6)} FROM customer_demographics"""), fixtures=SRC)
def q_load_summary(spark, sf):
    from halyard.sources.ingest import shape_summary
    src = sources(spark, sf)
    return round_doubles(shape_summary({"merged": C.merge_sources(src),
                                        "customer_demographics": src["customer_demographics"]}))


# ---- aggregates and joins ---------------------------------------------------

@register("txn_agg", f"""
SELECT customer_id, {R("SUM(amount)", 2)} AS total_transaction_amount, {R("AVG(amount)", 6)} AS avg_transaction_amount,
       COUNT(amount) AS transaction_count, MAX(transaction_date) AS last_transaction_date
FROM transactions GROUP BY customer_id""", fixtures=SRC)
def q_txn_agg(spark, sf):
    return round_doubles(C.txn_agg(X.transactions(spark, sf)), overrides={"total_transaction_amount": 2})


@register("ticket_agg", f"""
SELECT customer_id, {R("AVG(resolution_time_hours)", 6)} AS avg_resolution_time,
       COUNT(resolution_time_hours) AS support_ticket_count
FROM support_tickets GROUP BY customer_id""", fixtures=SRC)
def q_ticket_agg(spark, sf):
    return round_doubles(C.ticket_agg(X.support_tickets(spark, sf)))


@register("join_transactions", f""", {_TXN_SQL}
SELECT {_DEMO_COLS}, {R("t.total_transaction_amount", 2)} AS total_transaction_amount,
       {R("t.avg_transaction_amount", 6)} AS avg_transaction_amount, t.transaction_count, t.last_transaction_date
FROM customer_demographics d LEFT JOIN t ON d.customer_id = t.customer_id""", fixtures=SRC)
def q_join_transactions(spark, sf):
    out = C.join_transactions(X.customer_demographics(spark, sf), X.transactions(spark, sf))
    return round_doubles(out, overrides={"total_transaction_amount": 2})


@register("join_tickets", f""", {_TKT_SQL}
SELECT {_DEMO_COLS}, {R("s.avg_resolution_time", 6)} AS avg_resolution_time, s.support_ticket_count
FROM customer_demographics d LEFT JOIN s ON d.customer_id = s.customer_id""", fixtures=SRC)
def q_join_tickets(spark, sf):
    return round_doubles(C.join_tickets(X.customer_demographics(spark, sf), X.support_tickets(spark, sf)))


@register("join_usage", f"""
SELECT {_DEMO_COLS}, {R("u.avg_monthly_usage_gb", 6)} AS avg_monthly_usage_gb, u.peak_usage_hours, u.streaming_services_used
FROM customer_demographics d LEFT JOIN product_usage u ON d.customer_id = u.customer_id""", fixtures=SRC)
def q_join_usage(spark, sf):
    return round_doubles(C.join_usage(X.customer_demographics(spark, sf), X.product_usage(spark, sf)))


_MERGED_OUT = ("customer_id, age, gender, tenure_months, contract_type, payment_method, internet_service, "
               f"{R("monthly_charges", 6)} AS monthly_charges, {R("total_charges", 6)} AS total_charges, churn, "
               f"{R("total_transaction_amount", 2)} AS total_transaction_amount, "
               f"{R("avg_transaction_amount", 6)} AS avg_transaction_amount, transaction_count, last_transaction_date, "
               f"{R("avg_resolution_time", 6)} AS avg_resolution_time, support_ticket_count, "
               f"{R("avg_monthly_usage_gb", 6)} AS avg_monthly_usage_gb, peak_usage_hours, streaming_services_used")


@register("customer_360", _with_merged(f"SELECT {_MERGED_OUT} FROM merged"), fixtures=SRC)
def q_customer_360(spark, sf):
    return round_doubles(merged(spark, sf), overrides={"total_transaction_amount": 2})


@register("fill_missing", _with_merged(f"SELECT {_MERGED_OUT} FROM merged"), fixtures=SRC)
def q_fill_missing(spark, sf):
    return round_doubles(C.fill_missing(merged(spark, sf, fill=False)), overrides={"total_transaction_amount": 2})


@register("defaulted_fields", f""", {_TXN_SQL}, {_TKT_SQL}
SELECT d.customer_id, COALESCE({R("t.total_transaction_amount", 2)}, 0) AS total_transaction_amount,
       COALESCE({R("t.avg_transaction_amount", 6)}, 0) AS avg_transaction_amount,
       CAST(COALESCE(t.transaction_count, 0) AS BIGINT) AS transaction_count,
       COALESCE({R("s.avg_resolution_time", 6)}, 0) AS avg_resolution_time,
       CAST(COALESCE(s.support_ticket_count, 0) AS BIGINT) AS support_ticket_count,
       COALESCE({R("u.avg_monthly_usage_gb", 6)}, 0) AS avg_monthly_usage_gb,
       CAST(COALESCE(u.streaming_services_used, 0) AS INT) AS streaming_services_used
FROM customer_demographics d LEFT JOIN t ON d.customer_id = t.customer_id
LEFT JOIN s ON d.customer_id = s.customer_id LEFT JOIN product_usage u ON d.customer_id = u.customer_id""", fixtures=SRC)
def q_defaulted_fields(spark, sf):
    from halyard.functions.scalar import default_optional_fields
    m = merged(spark, sf, fill=False)
    out = default_optional_fields(m).select(
        "customer_id", "total_transaction_amount", "avg_transaction_amount", "transaction_count",
        "avg_resolution_time", "support_ticket_count", "avg_monthly_usage_gb", "streaming_services_used")
    return round_doubles(out, overrides={"total_transaction_amount": 2})


@register("split_target", _with_merged(f"SELECT {_MERGED_OUT.replace(', churn,', ',')} FROM merged"), fixtures=SRC)
def q_split_target(spark, sf):
    features, _label = C.split_target(merged(spark, sf))
    return round_doubles(features, overrides={"total_transaction_amount": 2})


# ---- derived features -------------------------------------------------------

@register("charges_ratio", f"""
SELECT customer_id, {R("total_charges / (tenure_months + 1)", 6)} AS charges_per_month_ratio FROM customer_demographics""",
          fixtures=SRC)
def q_charges_ratio(spark, sf):
    return round_doubles(C.charges_ratio(X.customer_demographics(spark, sf)).select("customer_id", "charges_per_month_ratio"))


@register("tickets_per_month", _with_merged(f"""
SELECT customer_id, {R("support_ticket_count / (tenure_months + 1)", 6)} AS support_tickets_per_month FROM merged"""),
          fixtures=SRC)
def q_tickets_per_month(spark, sf):
    return round_doubles(C.tickets_per_month(merged(spark, sf)).select("customer_id", "support_tickets_per_month"))


@register("estimated_clv", f"""
SELECT customer_id, {R("monthly_charges * tenure_months", 6)} AS estimated_clv FROM customer_demographics""", fixtures=SRC)
def q_estimated_clv(spark, sf):
    return round_doubles(C.estimated_clv(X.customer_demographics(spark, sf)).select("customer_id", "estimated_clv"))


@register("contract_risk", """
SELECT customer_id, CASE contract_type WHEN 'Month-to-month' THEN 3 WHEN 'One year' THEN 2 WHEN 'Two year' THEN 1 END
       AS contract_risk_score FROM customer_demographics""", fixtures=SRC)
def q_contract_risk(spark, sf):
    return C.contract_risk(X.customer_demographics(spark, sf)).select("customer_id", "contract_risk_score")


@register("age_group", """
SELECT customer_id, age, CASE WHEN age > 0 AND age <= 30 THEN 'Young' WHEN age > 30 AND age <= 50 THEN 'Middle'
       WHEN age > 50 AND age <= 70 THEN 'Senior' WHEN age > 70 AND age <= 100 THEN 'Elder' ELSE 'nan' END AS age_group
FROM customer_demographics""", fixtures=SRC)
def q_age_group(spark, sf):
    return C.age_group(X.customer_demographics(spark, sf)).select("customer_id", "age", "age_group")


@register("global_quantiles", _with_merged(f"""
SELECT {R("quantile_cont(avg_monthly_usage_gb, 0.33)", 6)} AS q_33, {R("quantile_cont(avg_monthly_usage_gb, 0.67)", 6)} AS q_67,
       (SELECT {R("quantile_cont(monthly_charges, 0.75)", 6)} FROM merged) AS q_75
FROM merged"""), fixtures=SRC)
def q_global_quantiles(spark, sf):
    m = merged(spark, sf)
    a = C.global_quantiles(m, "avg_monthly_usage_gb", C.USAGE_QUANTILES)
    b = C.global_quantiles(m, "monthly_charges", [C.HIGH_VALUE_QUANTILE])
    return round_doubles(a.crossJoin(b))


@register("usage_trend", _with_merged("""
, q AS (SELECT quantile_cont(avg_monthly_usage_gb, 0.33) AS q_33, quantile_cont(avg_monthly_usage_gb, 0.67) AS q_67 FROM merged)
SELECT customer_id, CASE WHEN avg_monthly_usage_gb <= q_33 THEN 'Low' WHEN avg_monthly_usage_gb <= q_67 THEN 'Medium'
       ELSE 'High' END AS usage_trend
FROM merged, q"""), fixtures=SRC)
def q_usage_trend(spark, sf):
    return C.usage_trend(merged(spark, sf)).select("customer_id", "usage_trend")


@register("high_value_flag", _with_merged("""
, q AS (SELECT quantile_cont(monthly_charges, 0.75) AS q_75 FROM merged)
SELECT customer_id, CAST(monthly_charges > q_75 AS INT) AS high_value_customer FROM merged, q"""), fixtures=SRC)
def q_high_value_flag(spark, sf):
    return C.high_value_flag(merged(spark, sf)).select("customer_id", "high_value_customer")


@register("target_distribution", f"""
SELECT churn, COUNT(*) AS n_rows, (SELECT COUNT(*) FROM customer_demographics) AS n_total,
       (SELECT {R("AVG(churn)", 6)} FROM customer_demographics) AS churn_rate
FROM customer_demographics GROUP BY churn""", fixtures=SRC)
def q_target_distribution(spark, sf):
    return round_doubles(C.target_distribution(X.customer_demographics(spark, sf)))
