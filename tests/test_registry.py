import pytest
from compare import database, difference
from conftest import TABLES

from __spark_entry__ import entry, oracle_sql, queries
from grainfold.registry.oracle import ORACLE
from grainfold.registry.queries import QUERIES

pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="the given tables are missing")


@pytest.fixture(scope="module")
def con():
    return database(str(TABLES))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    expected = con.execute(oracle_sql()[name]).df()
    assert difference(queries()[name](spark, str(TABLES)), expected) is None


def test_entry(spark):
    assert entry(spark).columns == ["locality", "n_photos", "tags"]


@pytest.mark.parametrize("name", list(QUERIES)[:11])
def test_same_result_without_broadcasts(spark, con, settings, name):
    """What holds for tables far beyond any broadcast: all joins sort and merge."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    )
    expected = con.execute(oracle_sql()[name]).df()
    assert difference(queries()[name](spark, str(TABLES)), expected) is None
