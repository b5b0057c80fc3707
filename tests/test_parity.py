"""Every registered query against its DuckDB oracle on the smoke data."""

import duckdb
import pytest

import __spark_entry__ as E
from jobsift.plans import catalog, oracle
from tests.conftest import SMOKE
from tools.parity import TABLES, rows_of

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    # of the library's own queries; optional parts may hold some that SQL cannot express
    assert set(oracle.SQL) == set(catalog.QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["region", "region_average"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SMOKE)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    d_cols, d_rows = rel.columns, rel.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
