"""User functions over rolling frames (the general case of a rolling lambda).

Built-ins cover the reference's only use (the slope, ``regr_slope``); this is the escape hatch for an arbitrary function
of the frame.  Rows are blocked as for the built-in features, and a block is one Arrow group: the function is called
once a block with all frames as the rows of a sliding numpy view, so Python runs per block and not per row.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from halyard.operators import timeseries as TS


def polyfit_slope(frames: np.ndarray) -> np.ndarray:
    """Least-squares slope of every row of ``frames`` against 0..n-1."""
    n = frames.shape[1]
    if n < 2:
        return np.full(len(frames), np.nan)
    x = np.arange(n) - (n - 1) / 2
    return (frames - frames.mean(axis=1, keepdims=True)) @ x / (x @ x)


def rolling_apply(df: DataFrame, col: str, window: int, fn: Callable[[np.ndarray], np.ndarray], ts: str,
                  series_col: str | None = None, out_col: str | None = None,
                  block_rows: int = TS.DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``fn`` over the last ``window`` rows of ``col``; NULL until the frame is full, and where it holds a NULL.

    ``fn`` gets a matrix with one frame a row and gives one number a row.
    """
    out_col = out_col or f"{col}_rolling_fn_{window}"
    rows = TS.blocked(TS.with_row_index(df, ts, series_col), series_col, window, block_rows)
    schema = T.StructType([*[rows.schema[c] for c in df.columns], T.StructField(out_col, T.DoubleType())])
    arrow, names = to_arrow_schema(schema), df.columns

    def one_block(block: pa.Table) -> pa.Table:
        block = block.sort_by(TS.IDX)
        values = block[col].cast(pa.float64()).to_numpy()  # NULL becomes NaN
        missing = np.asarray(block[col].is_null())
        out = np.full(len(values), np.nan)
        if len(values) >= window:
            frames = np.lib.stride_tricks.sliding_window_view(values, window)
            full = ~np.lib.stride_tricks.sliding_window_view(missing, window).any(axis=1)
            if full.any():
                out[window - 1:][full] = fn(frames[full])
        table = block.select(names).append_column(out_col, pa.array(out, mask=np.isnan(out)))
        return table.filter(block[TS.OWN]).cast(arrow)
    return rows.groupBy(*TS._keys(series_col), TS.BLOCK).applyInArrow(one_block, schema)
