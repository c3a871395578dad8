"""Every registered query against DuckDB on the smallest tables."""

import math
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry
from countryrank.plans import entries, io_entries  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    return con


def plain(v):
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(plain(x) for x in v)
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (int, float, np.integer, np.floating)):
        return round(float(v), 6)
    return str(v)


@pytest.mark.parametrize("name", sorted(entries.QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda df: sorted((tuple(plain(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False)), key=repr)
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
