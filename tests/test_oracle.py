import pytest

import __spark_entry__ as entry
from tests.oracle import difference, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(entry.table_sql()))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF) is None


def test_queries_without_sql_are_known():
    assert set(entry.table_queries()) - set(entry.table_sql()) == {"kmeans_train"}
    assert not set(entry.oracle_sql()) - set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark).orderBy("eps").collect()
    assert len(rows) == 13
    assert rows[0].n_kept < 200
