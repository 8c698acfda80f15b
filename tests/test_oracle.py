"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import os

import duckdb
import pandas as pd
import pytest

from senslake.plans.catalog import ORACLE_SQL, QUERIES
from senslake.sources.tables import TABLES
from tools.check import _hash, _norm

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data missing")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name not in ORACLE_SQL:
        assert len(got.columns) > 0
        return
    want = con.execute(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    a, b = _norm(got), _norm(want)
    assert len(a) == len(b)
    assert _hash(a) == _hash(b)
