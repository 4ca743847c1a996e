"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One Arrow batch handed to a Python worker: at most this many rows and about this many bytes, so that a
# worker's memory follows the longest text and not the partition.
BATCH_ROWS = "1000"
BATCH_BYTES = "8m"


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session's Python stages."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def packed(df: DataFrame, *more: Column) -> DataFrame:
    """``df``'s columns as one struct ``_row`` beside ``more``: names of the caller's columns cannot clash."""
    return df.select(F.struct(*[df[c] for c in df.columns]).alias("_row"), *more)


def unpacked(df: DataFrame, *more: Column) -> DataFrame:
    return df.select("_row.*", *more)


def held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32 of the id as text, mod 4, is 2; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def may_train(doc_id: str = "doc_id") -> Column:
    """Rows a model may learn from: a known id that is not held out."""
    return F.col(doc_id).isNotNull() & ~held_out(doc_id)


def bounded_sample(df: DataFrame, bound: int, key: Column, strata: Column | None = None) -> DataFrame:
    """About ``bound`` rows (per stratum), chosen by a hash of ``key``; every row where there are fewer.

    The counts come from one aggregate over ``strata`` alone, so the sample is the same on every run and
    no group is ordered or collected.
    """
    s = strata if strata is not None else F.lit(0)
    tagged = df.withColumn("_stratum", s)
    sizes = tagged.groupBy("_stratum").agg(F.count(F.lit(1)).alias("_rows"))
    share = F.least(F.lit(1.0), F.lit(float(bound)) / F.col("_rows"))
    point = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    # one row for each stratum, and strata are labels: a broadcast keeps the texts where they are
    return tagged.join(F.broadcast(sizes), tagged["_stratum"].eqNullSafe(sizes["_stratum"])) \
        .where(point < share).select(*[tagged[c] for c in df.columns])


def by_batch(fn: Callable[[list], pd.DataFrame], batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """``fn`` over each batch's list.  What Arrow has freed meanwhile goes back to the system: workers outlive their
    stage, and every one would keep the most that a batch has taken."""
    for s in batches:
        out = fn(s.tolist())
        pa.default_memory_pool().release_unused()
        yield out


def map_text(text: Column, fn: Callable[[list], pd.DataFrame], schema: T.StructType) -> Column:
    """``fn`` over lists of texts, one Arrow batch at a time, as a struct column."""
    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from by_batch(fn, batches)
    return run(text)
