"""Exact interpolated quantiles at any size, as one lazy plan.

Rows are counted per distinct value.  A sketch of the distinct values gives
bounds that cut them into about equal buckets; running counts are taken inside
each bucket and added to the totals of the buckets before it, so no task holds
more than a bucket and no buffer holds all values.  The bounds only decide the
balance: any bounds give the same exact result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 512
SKETCH_ACCURACY = 10_000


def quantile_name(p: float) -> str:
    return f"q_{int(round(p * 100))}"


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str] = (),
                    buckets: int = BUCKETS) -> DataFrame:
    """Columns ``q_<percent>`` per group (one row without ``by``): linear interpolation, nulls ignored."""
    keys = [F.col(c).alias(f"_g{i}") for i, c in enumerate(by)]
    g = [f"_g{i}" for i in range(len(by))] or ["_all"]
    rows = df.where(F.col(col).isNotNull()).select(*(keys or [F.lit(0).alias("_all")]), F.col(col).cast("double").alias("_v"))
    counts = rows.groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_n"))
    cuts = [i / buckets for i in range(1, buckets)]
    bounds = counts.groupBy(*g).agg(F.percentile_approx("_v", cuts, SKETCH_ACCURACY).alias("_bounds"))
    placed = counts.join(bounds, g).select(*g, "_v", "_n", F.size(F.filter("_bounds", lambda b: b < F.col("_v"))).alias("_b"))
    inside = Window.partitionBy(*g, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumn("_end", F.sum("_n").over(inside))
    # at most ``buckets`` rows a group
    totals = placed.groupBy(*g, "_b").agg(F.sum("_n").alias("_t"))
    before = Window.partitionBy(*g).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*g, "_b", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_before"),
                            F.sum("_t").over(Window.partitionBy(*g)).alias("_total"))
    ranked = local.join(offsets, [*g, "_b"]).withColumn("_end", F.col("_end") + F.col("_before"))
    picks = []
    for i, p in enumerate(probs):
        at = (F.col("_total") - 1) * F.lit(float(p))
        for name, k in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            here = (F.col("_end") - F.col("_n") <= k) & (k < F.col("_end"))
            picks.append(F.max(F.when(here, F.col("_v"))).alias(f"_{name}{i}"))
    picks.append(F.max("_total").alias("_total"))
    found = ranked.groupBy(*g).agg(*picks) if by else ranked.agg(*picks)
    out = []
    for i, p in enumerate(probs):
        at = (F.col("_total") - 1) * F.lit(float(p))
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        between = (F.ceil(at) - at) * lo + (at - F.floor(at)) * hi
        out.append(F.when(lo == hi, lo).otherwise(between).alias(quantile_name(p)))
    return found.select(*[F.col(f"_g{i}").alias(c) for i, c in enumerate(by)], *out)
