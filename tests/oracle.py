"""Shared Spark-vs-DuckDB comparison used by the tests and tools/oracle_check.py."""

from __future__ import annotations

import math

import duckdb

from halyard.sources.tables import BASE_TABLES


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v).replace("T", " ")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bool):
        return int(v)
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


SPARK_TO_DUCK = {"IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
                 "BooleanType": "BOOLEAN", "TimestampNTZType": "TIMESTAMP", "DateType": "DATE",
                 "ShortType": "SMALLINT", "FloatType": "FLOAT"}


def type_mismatches(spark_df, description):
    st = {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__, type(f.dataType).__name__) for f in spark_df.schema.fields}
    dt = {d[0]: str(d[1]) for d in description}
    return {c: (st[c], dt.get(c)) for c in st if c in dt and st[c] != dt[c] and not st[c].startswith("Array")}


def compare(spark_df, con, sql, check_types=True):
    scols = spark_df.columns
    srows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(scols) == sorted(dcols), (scols, dcols)
    if check_types:
        assert not type_mismatches(spark_df, res.description), type_mismatches(spark_df, res.description)
    a, b = canon(srows, scols), canon(drows, dcols)
    assert len(a) == len(b), (len(a), len(b))
    assert a == b
    return len(a)
