"""Every driver query against its DuckDB twin (sf0.001 for speed; the
driver checks sf0.01 with tests/oracle_check.py)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_check import compare, duck

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(SQL) <= set(QUERIES)
    missing = sorted(set(QUERIES) - set(SQL))
    assert missing == sorted(getattr(entry, "ROWS_ONLY", [])), missing


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF_SMALL, name, QUERIES[name], SQL[name], con)
    assert r["columns_match"], r
    assert r["match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["candidate_id", "cycle"]
