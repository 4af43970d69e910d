"""Layer 1: every registry query against its DuckDB twin (what the driver
checks at sf0.01; here on sf0.001 to stay quick)."""

import pytest

import __spark_entry__ as entry

from .conftest import SF_SMALL

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    import sys, os
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))
    from oracle_check import duck
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    """Every registry query runs; those with a SQL twin match it; none plans
    a cross join."""
    from oracle_check import compare
    r = compare(spark, name, QUERIES[name], SQL.get(name), SF_SMALL, con)
    assert r["status"] in ("match", "rows-only"), r
    assert name not in SQL or r["status"] == "match", r
    assert "cross_join" not in r, r


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["NotificationId", "notificationClicks", "notificationTotalCounts", "CTR", "rowNumber"]
    assert 0 < df.count() <= 5
