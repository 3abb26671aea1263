"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import differences, duck
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    result = entry.queries()[name](spark, SF)
    if name in entry.oracle_sql():
        assert differences(result, con, entry.oracle_sql()[name]) == []
    else:
        assert result.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
