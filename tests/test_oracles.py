import pytest
from oracle import differences, duck

import __spark_entry__ as driver

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", [n for n in driver.queries() if n in driver.oracle_sql()])
def test_query_matches_its_sql(spark, con, name):
    sql = driver.oracle_sql()[name]
    got = driver.queries()[name](spark, SF_DIR).toPandas()
    assert differences(got, con.execute(sql).df()) is None


def test_entry(spark):
    assert driver.entry(spark).count() == 10
