"""Every registered query against its SQL, on the smallest data."""

import pytest

import __spark_entry__ as contract
from compare import compare, connect
from tests.conftest import SF_DIR

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, QUERIES[name], ORACLES[name], SF_DIR) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry_has_a_stable_schema(spark):
    first, second = contract.entry(spark), contract.entry(spark)
    assert first.dtypes == second.dtypes == [("yearmonth", "string"), ("payment_type", "string"), ("count", "bigint")]
    assert not first.isEmpty()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
