"""Every registered query against its SQL counterpart."""

import pytest
from oracle import compare, connect

from tidemark.queries import REGISTRY


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, folder, con, name):
    query = REGISTRY[name]
    if query.sql is None:
        assert query.run(spark, folder).count() >= 0
    else:
        assert compare(spark, con, query, folder) is None


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
