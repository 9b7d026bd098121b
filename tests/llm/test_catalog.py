"""Every registered operator query at the smallest scale, against its SQL where there is one."""

import pytest

import __spark_entry__ as contract
from tagwright.llm.catalog import QUERIES
from tools.check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    agrees, note = compare(spark, con, SF_DIR, name)
    assert agrees, note


def test_all_are_registered():
    assert set(QUERIES) <= set(contract.queries())
