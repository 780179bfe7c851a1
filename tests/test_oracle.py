"""Every query that has SQL, at the smallest scale."""

import os

import pytest
from oracle import connect, difference

import __spark_entry__ as entry

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF).toPandas()
    assert difference(got, duck.execute(entry.oracle_sql()[name]).fetchdf()) == ""


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
