"""Every query of the subpackage on the smallest tables, against its SQL where it has one."""

import pytest

import __spark_entry__ as entry
from checks.compare import differences, duck
from kerbside.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_registered():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    result = QUERIES[name](spark, SF)
    if name in ORACLE:
        assert differences(result, duck(SF), ORACLE[name]) == []
    else:
        assert result.count() > 0
