"""Every registered query against its DuckDB oracle at sf0.001 (the driver runs sf0.01)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as se
from logweave.sources.tables import TABLES

SF = os.environ.get("LOGWEAVE_TEST_SF", "/root/testdata/sf0.001")


def _norm(v):
    import datetime as dt

    import numpy as np
    import pandas as pd
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (float, np.floating)):
        return round(float(v), 6)
    if isinstance(v, np.integer):
        return int(v)
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return sorted((tuple(_norm(r[c]) for c in cols) for _, r in pdf[cols].iterrows()), key=str)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(set(se.oracle_sql()) - set(se.LLM_SQL)))
def test_query_matches_oracle(spark, con, name):
    got = se.queries()[name](spark, SF).toPandas()
    exp = con.sql(se.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert _rows(got) == _rows(exp)


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0 and df.columns == ["window_start", "window_end", "status", "count"]
