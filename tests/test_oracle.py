"""Every registered query with a SQL twin equals DuckDB on the same tables;
rows-only queries run and return rows."""

import pytest

from quire.plans.catalog import load
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

REG = load()
SQL = sorted(n for n, (_, s) in REG.items() if s is not None)
ROWS = sorted(n for n, (_, s) in REG.items() if s is None)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", SQL)
def test_matches_duckdb(spark, con, name):
    fn, sql = REG[name]
    r = compare(spark, name, fn, sql, SF_SMALL, con)
    assert r["ok"], r
    assert not r.get("type_mismatch"), r


@pytest.mark.parametrize("name", ROWS)
def test_rows_only_queries_run(spark, name):
    assert REG[name][0](spark, SF_SMALL).count() > 0


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
