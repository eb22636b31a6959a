"""Every named query against its SQL oracle on the smallest star files."""

import os

import pytest
from compare import diff, duck, duck_table, spark_table

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="star files are not here")
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(ORACLE)))
def test_matches_oracle(spark, con, name):
    assert diff(spark_table(QUERIES[name](spark, SF)), duck_table(con, ORACLE[name])) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns and df.count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
