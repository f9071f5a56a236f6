import pytest
from oracle import connect, rows_of_duckdb, rows_of_spark

import __spark_entry__
from jobsluice.plans.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    assert rows_of_spark(QUERIES[name](spark, FOLDER)) == rows_of_duckdb(connect(FOLDER), ORACLES[name])
