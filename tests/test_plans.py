"""Plans of the registered queries: what reaches the scan, what is joined how."""

from sluiceway.functions.measures import money_percent, percent_of_amount
from sluiceway.plans import scorecard
from sluiceway.queries import QUERIES
from tests.conftest import SMALL

def plan_of(spark, name):
    return QUERIES[name].run(spark, SMALL)._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_what_is_needed(spark):
    plan = plan_of(spark, "billing_by_zone_month")
    assert "c_acctbal" not in plan and "c_mktsegment" not in plan
    assert "o_orderpriority" not in plan, "the address is not part of the mart"
    plan = plan_of(spark, "spend_by_zone_month")
    assert "l_shipdate" not in plan and "l_extendedprice" not in plan


def test_distinct_accounts_are_thinned_out_before_each_shuffle(spark):
    plan = plan_of(spark, "billing_by_zone_month")
    assert "partial_count(distinct account_id" in plan
    assert plan.count("Exchange hashpartitioning") == 3, "dedup, distinct accounts, mart"


def test_rules_are_pushed_below_the_join(spark):
    """NULL keys and bad lines go before any shuffle."""
    plan = plan_of(spark, "spend_by_zone_month")
    lines = plan[plan.index("partial_sum(cast(line_total") :]
    assert lines.index("Filter") < lines.index("FileScan")


def test_history_shuffles_once_per_step(spark):
    plan = plan_of(spark, "pii_scd2")
    assert plan.count("Exchange hashpartitioning") == 2, "one by account and day, one by account for both windows"


def test_telemetry_joins_locations_without_shuffling_readings_for_it(spark):
    plan = plan_of(spark, "telemetry")
    assert "BroadcastHashJoin [location_id" in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_works_orders_are_not_shuffled(spark):
    plan = plan_of(spark, "works_orders")
    assert "BroadcastHashJoin [zone" in plan and "Exchange hashpartitioning" not in plan


def test_spine_has_no_join(spark):
    zones = spark.createDataFrame(
        [("A", "r", 1, 4, True)],
        "zone_name string, region string, population_served int, sla_response_hours int, is_current boolean",
    )
    months = spark.sql("SELECT explode(array(DATE'2024-01-01', DATE'2024-02-01')) AS month_start_date")
    spine = scorecard.spine(zones, months)
    assert spine.count() == 2
    assert "Join" not in spine._jdf.queryExecution().executedPlan().toString()


def test_lines_cross_the_network_once_for_the_category_mart(spark):
    """To the join by invoice; the aggregation by zone and category gets partial sums."""
    plan = plan_of(spark, "spend_by_zone_category_month")
    assert plan.count("Exchange hashpartitioning(invoice_id") <= 2 and plan.count("Exchange hashpartitioning") <= 3
    assert "partial_sum(cast(line_total" in plan and "partial_sum(cast(unit_cost" in plan


def test_orders_without_a_zone_go_at_the_join(spark):
    plan = plan_of(spark, "works_orders")
    assert "Inner, BuildRight" in plan and "LeftOuter" not in plan


def test_amounts_are_rounded_once(spark):
    rows = [
        (50.0, 1234.565, 617.28), (33.33, 1e15, 333300000000000.0), (12.35, 0.1, 0.01), (0.0, 5.0, 0.0), (None, 5.0, None), (250.0, -0.014, -0.04),
    ]
    got = spark.createDataFrame([r[:2] for r in rows], "pct double, amount double").select(percent_of_amount("pct", "amount")).collect()
    assert [r[0] for r in got] == [r[2] for r in rows]
    shares = [
        (0.004, 0.016, 25.0), (1.0, 3.0, 33.33), (2.0, 3.0, 66.67), (-2.0, 3.0, -66.67), (2.0, -3.0, -66.67), (1.0, 0.0, None), (None, 1.0, None), (1.0, None, None),
        (0.123450, 1.0, 12.35), (0.123449, 1.0, 12.34), (1e18, 1e-6, None), (4.9e18, 9.8e18, 50.0), (0.0, 7.0, 0.0),
    ]
    got = spark.createDataFrame([r[:2] for r in shares], "part double, whole double").select(money_percent("part", "whole")).collect()
    assert [r[0] for r in got] == [r[2] for r in shares]


def test_the_history_is_built_once_before_it_is_checked(spark):
    """Both sides of the union built it anew, in the tasks that held the windows of the checks."""
    plan = QUERIES["scd2_checks"].run(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2 and plan.count("Window") == 1 and "o_orderkey" not in plan
