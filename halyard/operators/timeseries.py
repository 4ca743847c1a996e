"""Workload time-series features: lags, rolling statistics, trends, calendar.

Windows count **rows** (as the reference does), ordered by time within a
series.  A plain ``Window.partitionBy(series)`` would put a whole series in
one task, so a long or hot series is cut into blocks of ``block_rows`` rows;
each block also receives the last ``lookback`` rows of the block before it,
windows run per (series, block), and the copied rows are dropped again.  The
result equals the unblocked computation exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from halyard.functions.scalar import calendar_features, interaction_features

# Fixed values that must equal the reference's feature layout.
LAG_COLUMNS = ["cpu_usage", "memory_usage", "job_queue_length", "active_jobs"]
LAGS = [1, 2, 3, 6, 12, 24]
ROLLING_COLUMNS = ["cpu_usage", "memory_usage", "job_queue_length"]
ROLLING_WINDOWS = [3, 6, 12, 24]
TREND_COLUMNS = ["cpu_usage", "memory_usage"]
TREND_WINDOWS = [6, 12, 24]
TARGETS = ["cpu_usage", "memory_usage", "job_queue_length"]

SERIES = "_series"
IDX = "_idx"
BLOCK = "_blk"
OWN = "_own"
DEFAULT_BLOCK_ROWS = 200_000


def _keys(series_col: str | None) -> list[str]:
    return [series_col] if series_col else []


def with_row_index(df: DataFrame, ts: str, series_col: str | None = None, chunk_unit: str = "day") -> DataFrame:
    """Add ``_idx``: 0-based row position in time order within the series.

    Positions are computed per (series, day) chunk and shifted by the row
    count of earlier chunks (a small per-chunk table), so no task holds a
    whole series.
    """
    keys = _keys(series_col)
    chunk = F.date_trunc(chunk_unit, F.col(ts))
    ties = [c for c in df.columns if c != ts and c not in keys]  # rows with equal times keep one order in every run
    base = df.withColumn("_chunk", chunk)
    ranked = base.withColumn("_rk", F.row_number().over(Window.partitionBy(*keys, "_chunk").orderBy(ts, *ties)))
    counts = base.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_cn"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_chunk", F.coalesce(F.sum("_cn").over(before), F.lit(0)).alias("_off"))
    return (ranked.join(offsets, keys + ["_chunk"])
            .withColumn(IDX, F.col("_off") + F.col("_rk") - 1)
            .drop("_chunk", "_rk", "_off"))


def blocked(df: DataFrame, series_col: str | None, lookback: int, block_rows: int) -> DataFrame:
    """Assign ``_blk`` and copy each block's last ``lookback`` rows into the next block."""
    blk = F.floor(F.col(IDX) / block_rows)
    own = df.withColumn(BLOCK, blk).withColumn(OWN, F.lit(True))
    tail = (own.where(F.col(IDX) % block_rows >= block_rows - lookback)
            .withColumn(BLOCK, F.col(BLOCK) + 1).withColumn(OWN, F.lit(False)))
    return own.unionByName(tail)


def _window(series_col: str | None) -> Window:
    return Window.partitionBy(*_keys(series_col), BLOCK).orderBy(IDX)


def _full(frame_col: Column, w, n: int, value: Column) -> Column:
    """``value`` only where the frame holds ``n`` non-null inputs (pandas min_periods)."""
    return F.when(F.count(frame_col).over(w) == n, value)


def lag_exprs(columns, lags, w) -> list[Column]:
    return [F.lag(c, k).over(w).alias(f"{c}_lag_{k}") for c in columns for k in lags]


def rolling_exprs(columns, windows, w) -> list[Column]:
    out = []
    for c in columns:
        for n in windows:
            fw = w.rowsBetween(-(n - 1), 0)
            col = F.col(c)
            out += [
                _full(col, fw, n, F.avg(col).over(fw)).alias(f"{c}_rolling_mean_{n}"),
                _full(col, fw, n, F.stddev_samp(col).over(fw)).alias(f"{c}_rolling_std_{n}"),
                _full(col, fw, n, F.min(col).over(fw)).alias(f"{c}_rolling_min_{n}"),
                _full(col, fw, n, F.max(col).over(fw)).alias(f"{c}_rolling_max_{n}"),
            ]
    return out


def trend_exprs(columns, windows, w) -> list[Column]:
    """Least-squares slope over the last n rows (x = row position)."""
    out = []
    for c in columns:
        for n in windows:
            fw = w.rowsBetween(-(n - 1), 0)
            slope = F.regr_slope(F.col(c), F.col(IDX).cast("double")).over(fw)
            out.append(_full(F.col(c), fw, n, slope).alias(f"{c}_trend_{n}"))
    return out


def _windowed(df: DataFrame, ts: str, series_col: str | None, exprs_fn, lookback: int,
              block_rows: int) -> DataFrame:
    indexed = with_row_index(df, ts, series_col)
    b = blocked(indexed, series_col, lookback, block_rows)
    w = _window(series_col)
    out = b.select("*", *exprs_fn(w)).where(F.col(OWN))
    return out.drop(BLOCK, OWN)


def lag_features(df: DataFrame, ts: str = "timestamp", series_col: str | None = None, columns=None,
                 lags=None, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    columns = [c for c in (columns or LAG_COLUMNS) if c in df.columns]
    lags = lags or LAGS
    return _windowed(df, ts, series_col, lambda w: lag_exprs(columns, lags, w), max(lags), block_rows).drop(IDX)


def rolling_stats(df: DataFrame, ts: str = "timestamp", series_col: str | None = None, columns=None,
                  windows=None, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    columns = [c for c in (columns or ROLLING_COLUMNS) if c in df.columns]
    windows = windows or ROLLING_WINDOWS
    return _windowed(df, ts, series_col, lambda w: rolling_exprs(columns, windows, w),
                     max(windows), block_rows).drop(IDX)


def rolling_trend(df: DataFrame, ts: str = "timestamp", series_col: str | None = None, columns=None,
                  windows=None, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    columns = [c for c in (columns or TREND_COLUMNS) if c in df.columns]
    windows = windows or TREND_WINDOWS
    return _windowed(df, ts, series_col, lambda w: trend_exprs(columns, windows, w),
                     max(windows), block_rows).drop(IDX)


def timeseries_features(df: DataFrame, ts: str = "timestamp", series_col: str | None = None,
                        block_rows: int = DEFAULT_BLOCK_ROWS, dropna: bool = True,
                        keep_index: bool = False) -> DataFrame:
    """Calendar + lags + rolling + trends + interactions in one window pass; drop incomplete rows."""
    lag_cols = [c for c in LAG_COLUMNS if c in df.columns]
    roll_cols = [c for c in ROLLING_COLUMNS if c in df.columns]
    trend_cols = [c for c in TREND_COLUMNS if c in df.columns]

    def exprs(w):
        return (lag_exprs(lag_cols, LAGS, w) + rolling_exprs(roll_cols, ROLLING_WINDOWS, w)
                + trend_exprs(trend_cols, TREND_WINDOWS, w))

    out = _windowed(calendar_features(df, ts), ts, series_col, exprs, max(LAGS), block_rows)
    out = interaction_features(out)
    if dropna:
        out = out.na.drop("any")
    return out if keep_index else out.drop(IDX)


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def chrono_split(df: DataFrame, ts: str = "timestamp", series_col: str | None = None,
                 test_size: float = 0.2) -> DataFrame:
    """``split`` = train for the first rows, test for the last ceil(test_size * n)."""
    keys = _keys(series_col)
    indexed = with_row_index(df, ts, series_col)
    n = indexed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")) if keys else \
        indexed.agg(F.count(F.lit(1)).alias("_n"))
    joined = indexed.join(n, keys) if keys else indexed.crossJoin(F.broadcast(n))
    n_test = F.ceil(F.col("_n") * F.lit(test_size))
    return (joined.withColumn("split", F.when(F.col(IDX) < F.col("_n") - n_test, "train").otherwise("test"))
            .drop("_n", IDX))


# ---- one-row summaries (the served feature row) -----------------------------

def series_summary(df: DataFrame, series_col: str | None = None) -> DataFrame:
    aggs = [F.avg("cpu_usage").alias("cpu_mean"), F.stddev_samp("cpu_usage").alias("cpu_std"),
            F.avg("memory_usage").alias("memory_mean"), F.stddev_samp("memory_usage").alias("memory_std"),
            F.avg("job_queue_length").alias("queue_mean"), F.avg("active_jobs").alias("active_mean")]
    return df.groupBy(*_keys(series_col)).agg(*aggs)


def endpoint_trend(df: DataFrame, ts: str = "timestamp", series_col: str | None = None) -> DataFrame:
    """(last - first) / n for cpu and memory; 0 when n <= 1."""
    n = F.count(F.lit(1))
    g = df.groupBy(*_keys(series_col)).agg(
        n.alias("n_rows"),
        F.max_by("cpu_usage", ts).alias("_cl"), F.min_by("cpu_usage", ts).alias("_cf"),
        F.max_by("memory_usage", ts).alias("_ml"), F.min_by("memory_usage", ts).alias("_mf"),
    )
    return g.select(*_keys(series_col), "n_rows",
                    F.when(F.col("n_rows") > 1, (F.col("_cl") - F.col("_cf")) / F.col("n_rows")).otherwise(0.0).alias("cpu_trend"),
                    F.when(F.col("n_rows") > 1, (F.col("_ml") - F.col("_mf")) / F.col("n_rows")).otherwise(0.0).alias("memory_trend"))


def workload_feature_row(df: DataFrame, ts: str = "timestamp", series_col: str | None = None) -> DataFrame:
    """The 11-value summary row per series: stats, endpoint trends, calendar of the last timestamp."""
    keys = _keys(series_col)
    n = F.count(F.lit(1))
    g = df.groupBy(*keys).agg(
        F.avg("cpu_usage").alias("cpu_mean"), F.stddev_samp("cpu_usage").alias("cpu_std"),
        F.avg("memory_usage").alias("memory_mean"), F.stddev_samp("memory_usage").alias("memory_std"),
        F.avg("job_queue_length").alias("queue_mean"), F.avg("active_jobs").alias("active_mean"),
        n.alias("_n"),
        F.max_by("cpu_usage", ts).alias("_cl"), F.min_by("cpu_usage", ts).alias("_cf"),
        F.max_by("memory_usage", ts).alias("_ml"), F.min_by("memory_usage", ts).alias("_mf"),
        F.max(ts).alias("_last"),
    )
    trend = lambda last, first: F.when(F.col("_n") > 1, (F.col(last) - F.col(first)) / F.col("_n")).otherwise(0.0)
    return g.select(*keys, "cpu_mean", "cpu_std", "memory_mean", "memory_std", "queue_mean", "active_mean",
                    trend("_cl", "_cf").alias("cpu_trend"), trend("_ml", "_mf").alias("memory_trend"),
                    F.hour("_last").alias("hour"), F.weekday("_last").alias("day_of_week"),
                    F.month("_last").alias("month"))


def future_timestamps(df: DataFrame, horizon: int, ts: str = "timestamp", series_col: str | None = None) -> DataFrame:
    """Last timestamp + 1..horizon hours per series (``step``, ``timestamp``)."""
    keys = _keys(series_col)
    last = df.groupBy(*keys).agg(F.max(ts).alias("_last"))
    return last.select(*keys, F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"), "_last").select(
        *keys, "step", F.timestamp_add("HOUR", F.col("step"), F.col("_last")).alias("timestamp"))
