"""Every registered query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry_module
from conformance.compare import connect, difference
from conformance.queries import QUERIES

ORACLES = entry_module.oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, sf_dir, duck, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None


def test_entry_registers_every_query():
    assert set(QUERIES) <= set(entry_module.queries())
    assert ORACLES.items() <= entry_module.oracle_sql().items()


def test_entry_lands_and_reads_back(spark):
    rows = entry_module.entry(spark)
    assert rows.count() == 6000
    assert dict(rows.dtypes)["identifier"] == "string"
