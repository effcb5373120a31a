"""Runs catalog queries in Spark and their SQL in DuckDB and compares them."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _kind(value) -> str:
    if isinstance(value, (bool, np.bool_)):
        return "bool"
    if isinstance(value, (int, np.integer)):
        return "int"
    if isinstance(value, (float, np.floating)):
        return "float"
    return type(value).__name__


def _cell(value):
    if isinstance(value, (list, tuple, np.ndarray)):
        return tuple(_cell(v) for v in value)
    if value is None or value is pd.NaT or (isinstance(value, (float, np.floating)) and math.isnan(value)):
        return None
    if isinstance(value, (bool, np.bool_)):
        return bool(value)
    if isinstance(value, (int, np.integer)):
        return int(value)
    if isinstance(value, (float, np.floating)):
        return 0.0 if value == 0 else float(value)
    if hasattr(value, "to_pydatetime"):
        return value.to_pydatetime()
    return value


def rows_of(columns, tuples):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(t[i]) for i in order) for t in tuples]
    return sorted(columns), sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    return rows_of([d[0] for d in cur.description], cur.fetchall())


SPARK_KIND = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
              "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}


def type_differences(df, con, sql):
    duck = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return {n: (t, duck.get(n)) for n, t in df.dtypes if SPARK_KIND.get(t, t) != duck.get(n)}
