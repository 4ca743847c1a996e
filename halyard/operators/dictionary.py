"""A dictionary of category values as a table: dense ranks per column, joined back to encode.

Distinct (column, value) pairs are ranked by the skew-safe running totals, so a column with very many values is
spread over many tasks and no list of values reaches the driver; what does is one number a column.  The dictionary is
written once and joined column by column: Spark broadcasts a small one and shuffles a large one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halyard.operators.prefix import running_totals
from halyard.session import cut_lineage

NONE = "0"  # what a missing value stands as, like the reference's fill


def as_text(c: str) -> Column:
    """A category as text: dates in ISO order, NULL as ``NONE``."""
    return F.coalesce(F.col(c).cast("string"), F.lit(NONE))


def value_pairs(df: DataFrame, cols) -> DataFrame:
    """The distinct (column, value) pairs of ``df``, in one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), as_text(c).alias("value")) for c in cols])
    return df.select(F.explode(pairs).alias("p")).select("p.column", "p.value").distinct()


def dictionary(df: DataFrame, cols) -> DataFrame:
    """(column, value, index): the values of each column in order, from 0."""
    ranked = running_totals(value_pairs(df, cols), ["column"], [F.col("value").asc()], rank_col="_rank")
    return cut_lineage(ranked.select("column", "value", (F.col("_rank") - 1).cast("double").alias("index")), "dictionary")


def sizes(words: DataFrame) -> dict[str, int]:
    """Number of values of each column (one row a column)."""
    return {r["column"]: r["n"] for r in words.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}


def encode(df: DataFrame, words: DataFrame, cols) -> DataFrame:
    """``df`` with ``<col>_encoded`` for each of ``cols``; a value that the dictionary lacks gets the index after the last."""
    counts = sizes(words)
    for c in cols:
        own = words.where(F.col("column") == c).select(F.col("value").alias("_value"), F.col("index").alias("_index"))
        df = df.join(own, as_text(c) == F.col("_value"), "left") \
            .withColumn(f"{c}_encoded", F.coalesce(F.col("_index"), F.lit(float(counts.get(c, 0))))).drop("_value", "_index")
    return df
