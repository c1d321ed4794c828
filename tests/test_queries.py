"""Every registered query against its SQL statement on the given tables."""

import oracle_check as oc
import pytest

from winnowry.plans import registry

QUERIES = registry.load()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oc.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, sf_dir, name):
    q = QUERIES[name]
    df = q.build(spark, sf_dir)
    assert len(set(df.columns)) == len(df.columns)
    if q.sql is None:
        assert len(df.collect()) > 0
    else:
        assert oc.differences(df, con, q.sql) == []


def test_entry_points(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.FLAGSHIP in e.oracle_sql()
    assert e.entry(spark).count() > 0
