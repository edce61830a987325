"""Every query with SQL gives the same rows as that SQL in another engine."""

import pytest

from nomograph.queries import ORACLE_SQL, QUERIES
from tests.conftest import DATA
from tests.oracle import connect, same


@pytest.fixture(scope="module")
def other():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, other, name):
    same(QUERIES[name](spark, DATA), other, ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["work_uri", "celex_number", "is_consolidated", "resource_type", "date", "title"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
