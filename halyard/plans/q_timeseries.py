"""Workload telemetry queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from halyard.functions import scalar as S
from halyard.operators import timeseries as TS
from halyard.plans.registry import R, register, round_doubles
from halyard.sources import fixtures as X

TS_COL = "timestamp_h"
FIX = ("workload_hourly",)


def hourly(spark, sf):
    return X.workload_hourly(spark, sf)


def places(name: str) -> int:
    return 4 if ("_std_" in name or "_trend_" in name or name.endswith("_std")) else 6


def rounded(df):
    return round_doubles(df, overrides={c: places(c) for c in df.columns})


# ---- SQL generation from the same feature lists ------------------------------

BASE_COLS = ["cpu_usage", "memory_usage", "gpu_usage", "job_queue_length", "active_jobs", "cluster_size"]
IDX_CTE = f", h AS (SELECT *, ROW_NUMBER() OVER (ORDER BY {TS_COL}) - 1 AS idx FROM workload_hourly)\n"


def _ow(n=None):
    frame = f" ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW" if n else ""
    return f"OVER (ORDER BY idx{frame})"


DOUBLE_COLS = {"cpu_usage", "memory_usage", "gpu_usage"}


def _r(expr, col, name):
    return R(expr, places(name)) if col in DOUBLE_COLS else expr


def sql_lags(cols=TS.LAG_COLUMNS, lags=TS.LAGS):
    return [f"{_r(f'LAG({c}, {k}) {_ow()}', c, f'{c}_lag_{k}')} AS {c}_lag_{k}" for c in cols for k in lags]


def sql_rolling(cols=TS.ROLLING_COLUMNS, wins=TS.ROLLING_WINDOWS, rounding=True):
    out = []
    for c in cols:
        for n in wins:
            guard = f"CASE WHEN COUNT({c}) {_ow(n)} = {n} THEN"
            for stat, fn in (("mean", "AVG"), ("std", "STDDEV_SAMP"), ("min", "MIN"), ("max", "MAX")):
                name = f"{c}_rolling_{stat}_{n}"
                expr = f"{guard} {fn}({c}) {_ow(n)} END"
                if rounding and (stat in ("mean", "std") or c in DOUBLE_COLS):
                    expr = R(expr, places(name))
                out.append(f"{expr} AS {name}")
    return out


def sql_trends(cols=TS.TREND_COLUMNS, wins=TS.TREND_WINDOWS):
    out = []
    for c in cols:
        for n in wins:
            expr = f"CASE WHEN COUNT({c}) {_ow(n)} = {n} THEN REGR_SLOPE({c}, CAST(idx AS DOUBLE)) {_ow(n)} END"
            out.append(f"{R(expr, 4)} AS {c}_trend_{n}")
    return out


SQL_CALENDAR = [f"CAST(hour({TS_COL}) AS INT) AS hour", f"CAST(isodow({TS_COL}) - 1 AS INT) AS day_of_week",
                f"CAST(month({TS_COL}) AS INT) AS month",
                f"CAST(CASE WHEN isodow({TS_COL}) - 1 >= 5 THEN 1 ELSE 0 END AS INT) AS is_weekend"]
SQL_INTERACTIONS = [f"{R('cpu_usage / (memory_usage + 1e-8)')} AS cpu_memory_ratio",
                    f"{R('cpu_usage * memory_usage')} AS cpu_memory_product",
                    f"{R('job_queue_length / (active_jobs + 1)')} AS queue_active_ratio",
                    "job_queue_length + active_jobs AS total_jobs"]
SQL_BASE = [TS_COL] + [R(c) + f" AS {c}" if c in ("cpu_usage", "memory_usage", "gpu_usage") else c for c in BASE_COLS]


def _select(parts):
    return ",\n       ".join(parts)


# ---- scalar / calendar ------------------------------------------------------------

@register("calendar_features", f"SELECT {TS_COL}, {_select(SQL_CALENDAR)} FROM workload_hourly", fixtures=FIX)
def q_calendar(spark, sf):
    return S.calendar_features(hourly(spark, sf), TS_COL).select(TS_COL, "hour", "day_of_week", "month", "is_weekend")


@register("interaction_features", f"SELECT {TS_COL}, {_select(SQL_INTERACTIONS)} FROM workload_hourly", fixtures=FIX)
def q_interactions(spark, sf):
    out = S.interaction_features(hourly(spark, sf))
    return rounded(out.select(TS_COL, "cpu_memory_ratio", "cpu_memory_product", "queue_active_ratio", "total_jobs"))


@register("clamp_unit", f"""
SELECT {TS_COL}, {R('GREATEST(0.0, LEAST(1.0, cpu_usage * 3 - 0.5))')} AS cpu_clamped,
       {R('GREATEST(0.0, LEAST(1.0, 1.2 - memory_usage * 2))')} AS memory_clamped
FROM workload_hourly""", fixtures=FIX)
def q_clamp_unit(spark, sf):
    h = hourly(spark, sf)
    return rounded(h.select(TS_COL, S.clamp_unit(F.col("cpu_usage") * 3 - 0.5).alias("cpu_clamped"),
                            S.clamp_unit(1.2 - F.col("memory_usage") * 2).alias("memory_clamped")))


@register("clamp_count", f"""
SELECT {TS_COL}, CAST(GREATEST(0, TRUNC(job_queue_length * 0.7 - 10)) AS BIGINT) AS queue_clamped,
       CAST(GREATEST(0, TRUNC(active_jobs - 100.5)) AS BIGINT) AS active_clamped
FROM workload_hourly""", fixtures=FIX)
def q_clamp_count(spark, sf):
    h = hourly(spark, sf)
    return h.select(TS_COL, S.clamp_count(F.col("job_queue_length") * 0.7 - 10).alias("queue_clamped"),
                    S.clamp_count(F.col("active_jobs") - 100.5).alias("active_clamped"))


@register("future_timestamps", f"""
SELECT s.step, m.last_ts + s.step * INTERVAL 1 HOUR AS timestamp
FROM (SELECT MAX({TS_COL}) AS last_ts FROM workload_hourly) m, range(1, 25) s(step)""", fixtures=FIX)
def q_future_timestamps(spark, sf):
    return TS.future_timestamps(hourly(spark, sf), 24, TS_COL).withColumn("step", F.col("step").cast("bigint"))


@register("sort_by_time", f"SELECT {_select(SQL_BASE)} FROM workload_hourly ORDER BY {TS_COL}", fixtures=FIX)
def q_sort_by_time(spark, sf):
    return rounded(hourly(spark, sf).orderBy(TS_COL)).select(TS_COL, *BASE_COLS)


# ---- windows -----------------------------------------------------------------------

@register("lag_features", IDX_CTE + f"SELECT {TS_COL}, {_select(sql_lags())} FROM h", fixtures=FIX)
def q_lag_features(spark, sf):
    out = TS.lag_features(hourly(spark, sf), TS_COL)
    return rounded(out.select(TS_COL, *[f"{c}_lag_{k}" for c in TS.LAG_COLUMNS for k in TS.LAGS]))


@register("rolling_stats", IDX_CTE + f"SELECT {TS_COL}, {_select(sql_rolling())} FROM h", fixtures=FIX)
def q_rolling_stats(spark, sf):
    out = TS.rolling_stats(hourly(spark, sf), TS_COL)
    names = [f"{c}_rolling_{s}_{n}" for c in TS.ROLLING_COLUMNS for n in TS.ROLLING_WINDOWS
             for s in ("mean", "std", "min", "max")]
    return rounded(out.select(TS_COL, *names))


@register("rolling_trend", IDX_CTE + f"SELECT {TS_COL}, {_select(sql_trends())} FROM h", fixtures=FIX)
def q_rolling_trend(spark, sf):
    out = TS.rolling_trend(hourly(spark, sf), TS_COL)
    return rounded(out.select(TS_COL, *[f"{c}_trend_{n}" for c in TS.TREND_COLUMNS for n in TS.TREND_WINDOWS]))


@register("custom_rolling_fn", IDX_CTE + f"SELECT {TS_COL}, {sql_trends(['cpu_usage'], [6])[0]} FROM h", fixtures=FIX)
def q_custom_rolling_fn(spark, sf):
    from halyard.functions.udf import rolling_apply, polyfit_slope
    out = rolling_apply(hourly(spark, sf), "cpu_usage", 6, polyfit_slope, TS_COL, out_col="cpu_usage_trend_6")
    return rounded(out.select(TS_COL, "cpu_usage_trend_6"))


FEATURE_SQL_PARTS = (SQL_BASE + SQL_CALENDAR + sql_lags() + sql_rolling() + sql_trends() + SQL_INTERACTIONS)


def feature_names():
    names = [TS_COL] + BASE_COLS + ["hour", "day_of_week", "month", "is_weekend"]
    names += [f"{c}_lag_{k}" for c in TS.LAG_COLUMNS for k in TS.LAGS]
    names += [f"{c}_rolling_{s}_{n}" for c in TS.ROLLING_COLUMNS for n in TS.ROLLING_WINDOWS
              for s in ("mean", "std", "min", "max")]
    names += [f"{c}_trend_{n}" for c in TS.TREND_COLUMNS for n in TS.TREND_WINDOWS]
    return names + ["cpu_memory_ratio", "cpu_memory_product", "queue_active_ratio", "total_jobs"]


_FEATURES_SQL = IDX_CTE + f""", f AS (SELECT {_select(FEATURE_SQL_PARTS)} FROM h)
SELECT * FROM f WHERE {' AND '.join(f'{n} IS NOT NULL' for n in feature_names())}"""


@register("timeseries_features", _FEATURES_SQL, fixtures=FIX)
def q_timeseries_features(spark, sf):
    return rounded(TS.timeseries_features(hourly(spark, sf), TS_COL).select(*feature_names()))


@register("drop_incomplete", IDX_CTE + f""", f AS (SELECT {TS_COL}, {R('cpu_usage')} AS cpu_usage,
       LAG(cpu_usage, 24) {_ow()} AS cpu_lag_24 FROM h)
SELECT {TS_COL}, cpu_usage, {R('cpu_lag_24')} AS cpu_lag_24 FROM f WHERE cpu_lag_24 IS NOT NULL""", fixtures=FIX)
def q_drop_incomplete(spark, sf):
    lagged = TS.lag_features(hourly(spark, sf).select(TS_COL, "cpu_usage"), TS_COL, columns=["cpu_usage"], lags=[24])
    return rounded(TS.drop_incomplete(lagged).withColumnRenamed("cpu_usage_lag_24", "cpu_lag_24"))


@register("chrono_split", f"""
SELECT {TS_COL}, CASE WHEN ROW_NUMBER() OVER (ORDER BY {TS_COL}) - 1 < COUNT(*) OVER () - CEIL(COUNT(*) OVER () * 0.2)
       THEN 'train' ELSE 'test' END AS split
FROM workload_hourly""", fixtures=FIX)
def q_chrono_split(spark, sf):
    return TS.chrono_split(hourly(spark, sf).select(TS_COL), TS_COL)


# ---- one-row summaries ----------------------------------------------------------------

_SUMMARY_SQL = [f"{R('AVG(cpu_usage)')} AS cpu_mean", f"{R('STDDEV_SAMP(cpu_usage)', 4)} AS cpu_std",
                f"{R('AVG(memory_usage)')} AS memory_mean", f"{R('STDDEV_SAMP(memory_usage)', 4)} AS memory_std",
                f"{R('AVG(job_queue_length)')} AS queue_mean", f"{R('AVG(active_jobs)')} AS active_mean"]
_TREND_SQL = [f"{R('CASE WHEN COUNT(*) > 1 THEN (arg_max(cpu_usage, ' + TS_COL + ') - arg_min(cpu_usage, ' + TS_COL + ')) / COUNT(*) ELSE 0 END')} AS cpu_trend",
              f"{R('CASE WHEN COUNT(*) > 1 THEN (arg_max(memory_usage, ' + TS_COL + ') - arg_min(memory_usage, ' + TS_COL + ')) / COUNT(*) ELSE 0 END')} AS memory_trend"]


@register("series_summary", f"SELECT {_select(_SUMMARY_SQL)} FROM workload_hourly", fixtures=FIX)
def q_series_summary(spark, sf):
    return rounded(TS.series_summary(hourly(spark, sf)))


@register("endpoint_trend", f"SELECT COUNT(*) AS n_rows, {_select(_TREND_SQL)} FROM workload_hourly", fixtures=FIX)
def q_endpoint_trend(spark, sf):
    return rounded(TS.endpoint_trend(hourly(spark, sf), TS_COL))


@register("workload_feature_row", f"""
SELECT {_select(_SUMMARY_SQL + _TREND_SQL)}, CAST(hour(MAX({TS_COL})) AS INT) AS hour,
       CAST(isodow(MAX({TS_COL})) - 1 AS INT) AS day_of_week, CAST(month(MAX({TS_COL})) AS INT) AS month
FROM workload_hourly""", fixtures=FIX)
def q_workload_feature_row(spark, sf):
    return rounded(TS.workload_feature_row(hourly(spark, sf), TS_COL))


@register("feature_correlation", f"""
SELECT {R('CORR(cpu_usage, memory_usage)', 4)} AS cpu_memory_corr, {R('CORR(cpu_usage, gpu_usage)', 4)} AS cpu_gpu_corr,
       {R('CORR(memory_usage, gpu_usage)', 4)} AS memory_gpu_corr FROM workload_hourly""", fixtures=FIX)
def q_feature_correlation(spark, sf):
    h = hourly(spark, sf)
    out = h.agg(F.corr("cpu_usage", "memory_usage").alias("cpu_memory_corr"),
                F.corr("cpu_usage", "gpu_usage").alias("cpu_gpu_corr"),
                F.corr("memory_usage", "gpu_usage").alias("memory_gpu_corr"))
    return round_doubles(out, 4)


_SERIES_SQL = (_FEATURES_SQL.replace("OVER (ORDER BY idx", "OVER (PARTITION BY series_id ORDER BY idx")
               .replace(f"ROW_NUMBER() OVER (ORDER BY {TS_COL})", f"ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY {TS_COL})")
               .replace("FROM workload_hourly)", "FROM workload_hourly_series)")
               .replace(f"SELECT {TS_COL},", f"SELECT series_id, {TS_COL},", 1)
               .replace(f"f AS (SELECT {SQL_BASE[0]}", f"f AS (SELECT series_id, {SQL_BASE[0]}", 1))


@register("timeseries_features_by_series", _SERIES_SQL, fixtures=("workload_hourly_series",))
def q_timeseries_features_by_series(spark, sf):
    """Multi-series variant: windows per series_id (blocked within each series)."""
    h = X.workload_hourly(spark, sf, series_col=True)
    return rounded(TS.timeseries_features(h, TS_COL, series_col="series_id").select("series_id", *feature_names()))
