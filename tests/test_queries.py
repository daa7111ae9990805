"""Every core query that SQL can express returns the same rows as DuckDB on the smallest tables."""

import pytest
from compare import compare, duck

from archivolt import queries as q


@pytest.fixture(scope="module")
def con(smoke_dir):
    return duck(smoke_dir)


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_same_as_sql(spark, smoke_dir, con, name):
    assert compare(spark, con, smoke_dir, name, q.queries()[name], q.oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", sorted(set(q.queries()) - set(q.oracle_sql())))
def test_runs(spark, smoke_dir, name):
    df = q.queries()[name](spark, smoke_dir)
    assert df.columns and df.count() >= 0


def test_entry(spark, smoke_dir):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
