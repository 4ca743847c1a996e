"""Source loading, load summaries, JSON request ingest and table sinks."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

log = logging.getLogger(__name__)


def load_sources(spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet",
                 schemas: Mapping[str, T.StructType] | None = None, **options) -> dict[str, DataFrame]:
    """Read each configured source; a missing path is skipped with a warning.

    ``schemas`` pins the types (no inference pass over the data); CSV gets
    ``header`` and, without a schema, ``inferSchema`` like the reference.
    """
    schemas = schemas or {}
    out: dict[str, DataFrame] = {}
    for name, path in paths.items():
        reader = spark.read.format(fmt).options(**options)
        if name in schemas:
            reader = reader.schema(schemas[name])
        elif fmt == "csv":
            reader = reader.option("header", "true").option("inferSchema", "true")
        try:
            out[name] = reader.load(path)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":  # a wrong schema or format is an error
                raise
            log.warning("source %s not found at %s: %s", name, path, exc.getMessage() if hasattr(exc, "getMessage") else exc)
    return out


def load_summary_table(sources: Mapping[str, DataFrame]) -> DataFrame:
    """One row per loaded source: name and row count (one pass each)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("source"), "n_rows")
             for name, df in sources.items() if df is not None]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def shape_summary(tables: Mapping[str, DataFrame], label: str = "churn") -> DataFrame:
    """Row count and label rate per named table (the load / merge log lines)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"), F.avg(label).alias("churn_rate"))
             .select(F.lit(name).alias("stage"), "n_rows", "churn_rate") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_processed(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None) -> str:
    """Overwrite ``path`` with ``df`` (distributed write, one file per task)."""
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)


def reuse_or_rebuild(spark: SparkSession, path: str, build, fmt: str = "parquet") -> DataFrame:
    """Read the processed table at ``path``; build and write it first if absent."""
    if not path_exists(spark, path):
        write_processed(build(), path, fmt)
    return spark.read.format(fmt).load(path)


def ingest_json(lines: DataFrame, schema: T.StructType, column: str = "value",
                corrupt_col: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """Parse JSON text rows with a fixed schema; split off rejects.

    PERMISSIVE parsing keeps the batch alive: a malformed or mistyped row
    becomes a reject row carrying its raw text instead of failing the job.
    """
    full = T.StructType(schema.fields + [T.StructField(corrupt_col, T.StringType(), True)])
    parsed = lines.select(F.from_json(F.col(column), full,
                                      {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_col}).alias("r"),
                          F.col(column).alias("_raw"))
    bad = F.col(f"r.{corrupt_col}").isNotNull() | F.col("r").isNull()
    good = parsed.where(~bad).select(*[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields])
    rejects = parsed.where(bad).select(F.col("_raw").alias("raw_record"))
    return good, rejects
