"""Every registered query against its check SQL, on the smallest sample tables."""

import pytest

import __spark_entry__ as contract
from compare import compare, connect
from eventloom.plans.checks import CHECKS
from eventloom.plans.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_a_check():
    assert set(REGISTRY) == set(CHECKS)
    assert set(REGISTRY) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, db, name):
    df = contract.queries()[name](spark, SF_DIR)
    assert compare(df, db, contract.oracle_sql()[name]) is None
