"""Every catalog query against its SQL, over whole tables."""

import oracle
import pytest

from lodestream.plans import catalog

WITHOUT_SQL = sorted(set(catalog.QUERIES) - set(catalog.ORACLES))


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_sql(spark, sf, con, name):
    df = catalog.QUERIES[name](spark, sf)
    sql = catalog.ORACLES[name]
    assert oracle.type_differences(df, con, sql) == {}
    columns, rows = oracle.spark_rows(df)
    assert (columns, rows) == oracle.duck_rows(con, sql)


@pytest.mark.parametrize("name", WITHOUT_SQL)
def test_runs(spark, sf, name):
    assert catalog.QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 33
    assert set(entry.oracle_sql()) <= set(entry.queries())
