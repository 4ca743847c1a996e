"""Exact running totals without one task per group.

``Window.partitionBy(group).orderBy(key)`` sends a whole group to one task;
with a hot group (one request, node, user or score column holding a large
share of the rows) that task is the job.  Here the rows are range-partitioned
on (group, key) instead, so a hot group is split across many tasks; each task
computes local running sums, and a small table of per-partition totals gives
every (partition, group) the sum of the partitions before it.

Range bounds come from sampling, and the sample depends on input order, so
the range-partitioned table is written once with a reliable checkpoint (the
shared ``spark.checkpoint.dir``) before it is read twice; a recomputation
after a lost executor cannot then assign rows to different partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from halyard.session import cut_lineage


def _parts(df: DataFrame, parts: int | None) -> int:
    if parts:
        return parts
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def running_totals(df: DataFrame, group_cols, order_exprs: list[Column], sum_cols=(),
                   rank_col: str | None = None, parts: int | None = None,
                   prefix: str = "cum_") -> DataFrame:
    """Add inclusive running sums ``cum_<c>`` (and a 1-based ``rank_col``) per group in order.

    ``order_exprs`` must order rows within a group totally (add a unique
    tie-breaker), otherwise ties are cut arbitrarily.
    """
    group_cols = list(group_cols)
    sums = list(sum_cols)
    base = df
    if rank_col:
        base = base.withColumn("_one", F.lit(1).cast("bigint"))
        sums.append("_one")
    ranged = base.repartitionByRange(_parts(df, parts), *[F.col(c) for c in group_cols], *order_exprs) \
        .withColumn("_pid", F.spark_partition_id())
    ranged = cut_lineage(ranged)
    grp = ["_pid", *group_cols]
    w_run = Window.partitionBy(*grp).orderBy(*order_exprs).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.select("*", *[F.sum(c).over(w_run).alias(f"_run_{c}") for c in sums])
    totals = ranged.groupBy(*grp).agg(*[F.sum(c).alias(f"_tot_{c}") for c in sums])
    # at most one row per (range partition, group): tiny next to the data
    w_before = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*grp, *[F.coalesce(F.sum(f"_tot_{c}").over(w_before), F.lit(0)).alias(f"_off_{c}")
                                    for c in sums])
    out = local.join(offsets, grp)
    cols = [F.col(c) for c in df.columns]
    cols += [(F.col(f"_run_{c}") + F.col(f"_off_{c}")).alias(f"{prefix}{c}") for c in sum_cols]
    if rank_col:
        cols.append((F.col("_run__one") + F.col("_off__one")).alias(rank_col))
    return out.select(*cols)


def running_max_plus(df: DataFrame, group_cols, order_exprs: list[Column], dur_col: str, rel_col: str,
                     parts: int | None = None) -> DataFrame:
    """Sequential start/end times per group without one task per group.

    For rows in order with duration d and release time r:
    end_i = S_i + max_{j<=i}(r_j - S_{j-1}) with S the running sum of d.
    Adds ``_end`` and ``_rank`` (1-based).  Same range-partition scheme as
    ``running_totals``: local running sum and running max per partition,
    plus per-partition offsets (sum of earlier durations, best earlier max).
    """
    group_cols = list(group_cols)
    ranged = cut_lineage(df.repartitionByRange(_parts(df, parts), *[F.col(c) for c in group_cols], *order_exprs)
                         .withColumn("_pid", F.spark_partition_id()), "maxplus")
    grp = ["_pid", *group_cols]
    w = Window.partitionBy(*grp).orderBy(*order_exprs).rowsBetween(Window.unboundedPreceding, 0)
    local = (ranged.withColumn("_ls", F.sum(dur_col).over(w))
             .withColumn("_a", F.col(rel_col) - (F.col("_ls") - F.col(dur_col)))
             .withColumn("_lm", F.max("_a").over(w))
             .withColumn("_lr", F.row_number().over(Window.partitionBy(*grp).orderBy(*order_exprs))))
    totals = ranged.withColumn("_ls", F.sum(dur_col).over(w)) \
        .withColumn("_a", F.col(rel_col) - (F.col("_ls") - F.col(dur_col))) \
        .groupBy(*grp).agg(F.sum(dur_col).alias("_ts"), F.max("_a").alias("_tm"), F.count(F.lit(1)).alias("_tn"))
    before = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = (totals.withColumn("_os", F.coalesce(F.sum("_ts").over(before), F.lit(0)))
            .withColumn("_on", F.coalesce(F.sum("_tn").over(before), F.lit(0)))
            .withColumn("_gm", F.col("_tm") - F.col("_os"))
            .withColumn("_om", F.max("_gm").over(before))
            .select(*grp, "_os", "_on", "_om"))
    t = local.join(offs, grp)
    m = F.greatest(F.coalesce(F.col("_om"), F.col("_lm") - F.col("_os")), F.col("_lm") - F.col("_os"))
    return t.select(*[F.col(c) for c in df.columns], (F.col("_ls") + F.col("_os") + m).alias("_end"),
                    (F.col("_lr") + F.col("_on")).alias("_rank"))
