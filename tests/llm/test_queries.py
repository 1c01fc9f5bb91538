"""Every query of the operators that SQL can express, on whole small tables; all are registered with the driver."""

import pytest

import __spark_entry__ as entry_module
from sluiceway.llm.queries import QUERIES, SQL
from tests.compare import compare
from tests.conftest import SMALL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(session, duck, name):
    assert compare(QUERIES[name](session, SMALL), duck, SQL[name]) == []


def test_the_driver_gets_one_query_for_each_operator():
    names = [n for n in entry_module.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry_module.queries()
    assert set(SQL) <= set(entry_module.oracle_sql())
