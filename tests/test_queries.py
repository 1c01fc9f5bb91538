"""Every registered query against its SQL, on whole small tables."""

import re

import pytest

import __spark_entry__ as entry_module
from sluiceway.queries import QUERIES
from tests.compare import compare
from tests.conftest import SMALL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    query = QUERIES[name]
    assert query.sql, "every query here can be said in SQL"
    result = query.run(spark, SMALL)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|InPandas|ArrowEval", plan)
    assert compare(result, duck, query.sql) == []


def test_entry_points(spark):
    assert entry_module.entry(spark).columns == [
        "service_zone", "month_start_date", "total_consumption", "total_billed",
        "total_accounts", "overdue_count", "overdue_rate_pct",
    ]
    assert set(QUERIES) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in {"scd2_sound"}))
def test_no_check_is_empty(duck, name):
    """A check that compares nothing with nothing proves nothing."""
    rows = duck.execute(f"SELECT count(*) FROM ({QUERIES[name].sql})").fetchall()[0][0]
    assert rows > 0
