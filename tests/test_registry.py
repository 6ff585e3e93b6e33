import pytest

import __spark_entry__ as entry
from tests.oracle import connect, difference

SMALL = "/root/testdata/sf0.001"
OWN = [n for n in entry.queries() if n in entry.oracle_sql() and not n.startswith("op") and n != "pipeline"]


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", OWN)
def test_query_equals_its_oracle(spark, con, name):
    assert difference(entry.queries()[name](spark, SMALL), entry.oracle_sql()[name], con) is None


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
