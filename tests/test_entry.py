"""Driver contract and oracle agreement on the smallest scale factor."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from fishladder.plans.queries import REGISTRY
from tools.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "median_lgr" in df.columns


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) & set(REGISTRY)))
def test_query_matches_oracle(spark, con, name):
    s_cols, s_rows = rows_of(E.queries()[name](spark, SF).toPandas())
    o_cols, o_rows = rows_of(con.execute(E.oracle_sql()[name]).df())
    assert s_cols == o_cols
    assert s_rows == o_rows
