"""Spark against DuckDB on the same tables."""

import os
from collections import Counter

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        con.sql(f"CREATE VIEW {table} AS FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def _value(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, list):
        return str([_value(x) for x in v])
    if v is None or v is pd.NA or v != v:
        return None
    return f"{v:.9g}" if isinstance(v, float) else str(v)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return Counter(tuple(map(_value, r)) for r in frame.itertuples(index=False))


def same(spark_df, con, sql):
    mine, theirs = spark_df.toPandas(), con.sql(sql).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    a, b = rows(mine), rows(theirs)
    assert a == b, (list((a - b).items())[:2], list((b - a).items())[:2])
