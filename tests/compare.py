"""Rows of a Spark query and of DuckDB over the same tables, in one form."""

import os

import duckdb
import numpy as np
import pandas as pd


def plain(x):
    if x is None or x is pd.NA or x is pd.NaT:
        return ""
    if isinstance(x, (bool, np.bool_)):
        return str(bool(x))
    if isinstance(x, (int, float, np.integer, np.floating)):
        return "" if x != x else f"{float(x):.9g}"
    if isinstance(x, (list, tuple, np.ndarray)):
        return str([plain(y) for y in x])
    return str(x)


def rows(frame):
    names = sorted(frame.columns)
    return names, sorted(tuple(plain(v) for v in r) for r in frame[names].itertuples(index=False))


def duck(sf_dir, sql):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    return con.sql(sql).df()
