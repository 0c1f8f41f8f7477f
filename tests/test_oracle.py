"""Every registered query against its reference SQL."""

import os
import re

import pytest

import __spark_entry__
from tests.oracle import connect, difference

QUERIES, ORACLES = __spark_entry__.queries(), __spark_entry__.oracle_sql()
FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    # those of the document operators that SQL cannot express are tested beside the operators
    assert ORACLES.keys() <= QUERIES.keys()
    assert all(re.match(r"op\d+_|pipeline$", name) for name in QUERIES.keys() - ORACLES.keys())


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, ORACLES[name]) is None


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["document_id", "outcome"]
