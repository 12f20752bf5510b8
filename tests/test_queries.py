"""Every query with SQL gives the same rows in DuckDB."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from panelyx.plans import ORACLES, QUERIES


@pytest.fixture(scope="session")
def duck(sf_dir):
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for f in os.listdir(sf_dir):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{f}'")
    return c


def _plain(v):
    if v is None or v is pd.NaT or isinstance(v, float) and np.isnan(v):
        return "NULL"
    if isinstance(v, float) and v == 0:
        return "0.0"
    return str(v.date() if hasattr(v, "date") and callable(v.date) else v)


def rows_of(df, columns):
    return sorted(tuple(map(_plain, r)) for r in df[columns].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(name, spark, sf_dir, duck):
    ours, theirs = QUERIES[name](spark, sf_dir).toPandas(), duck.sql(ORACLES[name]).df()
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    assert rows_of(ours, columns) == rows_of(theirs, columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() >= 0
