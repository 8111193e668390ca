import os

import pytest

import __spark_entry__
from ludolake.checks.oracle import ORACLE
from ludolake.checks.queries import QUERIES

from .compare import difference, duck

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables not present")


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, connection, name):
    assert difference(QUERIES[name](spark, SMALL), connection, ORACLE[name]) is None


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 50
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(__spark_entry__.queries())
