"""Named queries and their DuckDB oracle SQL.

Every query takes ``(spark, sf_dir)`` and returns a lazy DataFrame built
from the supplied tables.  Doubles in the outputs are rounded (6 places,
fewer where summation order or a std makes the last digits unstable) so the
Spark result and the oracle compare exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halyard.sources.fixtures import with_fixtures

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, fixtures=()):
    """Register ``fn`` under ``name``; ``sql`` gets the fixture CTEs prefixed."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_fixtures(sql, fixtures) if fixtures else sql
        return fn
    return deco


def rnd(col, places: int = 6):
    """floor(x * 10^p + 0.5) / 10^p: the same IEEE steps in Spark and DuckDB.

    Spark's ``round`` rounds the shortest decimal string HALF_UP while DuckDB
    rounds the binary value; on half-way values they differ.  This form is
    bit-identical in both engines for identical inputs.  The relative bias
    (1e-11) exceeds summation-order noise, so exact decimal ties (common
    with cent-valued data) round up in both engines whatever the order.
    """
    scale = float(10 ** places)
    c = F.col(col) if isinstance(col, str) else col
    y = c * scale
    return F.floor(y + 0.5 + F.abs(y) * 1e-11) / scale


def R(expr: str, places: int = 6) -> str:
    """SQL twin of :func:`rnd`."""
    y = f"(({expr}) * 1e{places})"
    return f"(FLOOR({y} + 0.5 + ABS({y}) * 1e-11) / 1e{places})"


def round_doubles(df: DataFrame, places: int = 6, overrides: dict[str, int] | None = None) -> DataFrame:
    """Round every double column (``overrides`` sets places per column)."""
    overrides = overrides or {}
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(rnd(F.col(f.name), overrides.get(f.name, places)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
