import pytest
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, SF, name, queries(), oracle_sql()) is None


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_rows_only_queries_give_rows(spark):
    for name in set(queries()) - set(oracle_sql()):
        assert queries()[name](spark, SF).count() > 0


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["country_code", "sales_month", "total_sales", "number_of_sales"]
    assert df.count() > 0
