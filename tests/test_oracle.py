"""Every registered query equals its DuckDB oracle (sf0.001: row count,
column names and the multiset of values, NULL-aware)."""

import math

import duckdb
import pandas as pd
import pytest

from enrichkit.plans import catalog, oracle
from enrichkit.plans.tables import TABLES

from .conftest import SF_SMALL


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return "NULL"
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        f = float(v)
        return "NULL" if math.isnan(f) else repr(f)
    if hasattr(v, "tolist"):
        return repr(v.tolist())
    return repr(v)


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records"))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, duck, name):
    got = _rows(catalog.queries()[name](spark, SF_SMALL).toPandas())
    want = _rows(duck.sql(oracle.oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
