"""Rules under three-valued logic: kept and rejected rows add up, whatever is NULL."""

import datetime as dt
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sluiceway import config
from sluiceway.config import Settings
from sluiceway.operators.quarantine import FIRST, bad_rows, good_rows, quarantine, with_verdict
from sluiceway.operators.rules import (
    DROP, FAIL, WARN, dq_metrics, enforce, enforce_observed, fail_on_violation, flag_known, rules, split,
)
from sluiceway.plans import contractors

NOW = dt.datetime(2024, 6, 1, 12, 0, 0)
SETTINGS = Settings(as_of=dt.date(2024, 6, 1), processed_at=NOW, lanes=4)
ORDERS = "work_order_id string, zone_id string, cost double, completion_date date, description string"
GOOD_DAY = dt.date(2024, 1, 1)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_null_cost_is_rejected_with_every_reason(spark):
    """A NULL test neither lets a row vanish nor hides a reason."""
    df = spark.createDataFrame(
        [("a", "Z", None, GOOD_DAY, "x"), ("b", "Z", None, GOOD_DAY, None), ("c", "Z", 5.0, GOOD_DAY, "x")], ORDERS
    )
    good, bad = split(df, config.works_rules(SETTINGS))
    assert [r.work_order_id for r in good.collect()] == ["c"]
    assert bad.count() == 2
    reasons = {r.work_order_id: r._quarantine_reason for r in quarantine(df, config.works_rules(SETTINGS), NOW).collect()}
    assert reasons["a"] == "positive_cost, reasonable_cost"
    assert reasons["b"] == "positive_cost, valid_description, reasonable_cost"


@pytest.mark.parametrize(
    ("cost", "day", "reason"),
    [
        (0.0, GOOD_DAY, "positive_cost"),
        (99999.99, GOOD_DAY, None),
        (100000.0, GOOD_DAY, "reasonable_cost"),
        (1.0, dt.date(2019, 12, 31), "valid_date_range"),
        (1.0, dt.date(2020, 1, 1), None),
        (1.0, dt.date(2024, 6, 1), None),
        (1.0, dt.date(2024, 6, 2), "valid_date_range"),
        (1.0, None, "valid_completion_date, valid_date_range"),
    ],
)
def test_works_limits(spark, cost, day, reason):
    df = spark.createDataFrame([("a", "Z", cost, day, "x")], ORDERS)
    rejected = quarantine(df, config.works_rules(SETTINGS), NOW).collect()
    assert [r._quarantine_reason for r in rejected] == ([reason] if reason else [])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.sampled_from([None, "a"]),
            st.sampled_from([None, "Z"]),
            st.sampled_from([None, -1.0, 0.0, 5.0, 1e6]),
            st.sampled_from([None, dt.date(2019, 1, 1), GOOD_DAY, dt.date(2030, 1, 1)]),
            st.sampled_from([None, "x"]),
        ),
        max_size=30,
    )
)
def test_both_sides_add_up(spark, data):
    df = spark.createDataFrame(data, ORDERS)
    good, bad = split(df, config.works_rules(SETTINGS))
    assert rows_of(good) + rows_of(bad) == Counter(data)
    routed = with_verdict(df, config.works_rules(SETTINGS), NOW)
    assert rows_of(good_rows(routed)) == rows_of(good)
    assert all(r._quarantine_reason for r in bad_rows(routed).collect())


def test_first_reason_follows_rule_order(spark):
    df = spark.createDataFrame(
        [(None, None, 1.0, 1.0), ("a", "m", None, None), ("a", "m", 1.0, None), ("a", "m", 1.0, 1.0)],
        "account_id string, meter_id string, consumption_value double, amount_billed double",
    )
    rejected = quarantine(df, config.BILL_HARD, NOW, FIRST, "bronze.bills").collect()
    assert [r.quarantine_reason for r in rejected] == ["missing account_id", "missing consumption", "missing amount_billed"]
    assert {r.source_table for r in rejected} == {"bronze.bills"}
    assert {r.quarantined_at for r in rejected} == {NOW}


def test_fail_rule_stops_with_its_name(spark):
    df = spark.createDataFrame([("Z",), (None,)], "zone string")
    with pytest.raises(Exception, match="rule valid_zone is broken"):
        fail_on_violation(df, rules(FAIL, valid_zone="zone IS NOT NULL")).collect()
    assert fail_on_violation(df.where("zone IS NOT NULL"), rules(FAIL, valid_zone="zone IS NOT NULL")).count() == 1


def test_fail_rule_sees_only_rows_that_reach_it(spark):
    """The check must not be moved below the join or the filter that removes the bad row."""
    left = spark.createDataFrame([(1, None, "keep"), (2, "Z", "keep"), (3, None, "drop")], "k int, zone string, note string")
    right = spark.createDataFrame([(2,), (3,)], "k int")
    joined = left.where("note <> 'drop'").join(right, "k")
    assert fail_on_violation(joined, rules(FAIL, valid_zone="zone IS NOT NULL")).count() == 1
    grouped = joined.groupBy("zone").count()
    checked = fail_on_violation(grouped, rules(FAIL, valid_zone="zone IS NOT NULL"))
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("raise_error") < plan.index("Aggregate")


def test_observed_counts_come_with_the_write(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "v int")
    rule_set = (*rules(DROP, present="v IS NOT NULL"), *rules(WARN, positive="v > 0"))
    kept, observation = enforce_observed(df, rule_set)
    assert kept.count() == 2
    assert observation.get == {"rows": 3, "present": 1, "positive": 2}


def test_layer_policy(spark):
    """Warn keeps all, drop removes, fail stops."""
    df = spark.createDataFrame([(None,), (1,)], "v int")
    assert enforce(df, rules(WARN, present="v IS NOT NULL")).count() == 2
    assert enforce(df, rules(DROP, present="v IS NOT NULL")).count() == 1
    with pytest.raises(Exception, match="present"):
        enforce(df, rules(FAIL, present="v IS NOT NULL")).collect()


def test_metrics(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 20000.0)], "g string, v double")
    rule_set = rules(WARN, bound="v < 10000", present="v IS NOT NULL")
    got = {(r.rule): (r.passed, r.failed, r.failed_pct) for r in dq_metrics(df, rule_set, "d").collect()}
    assert got == {"bound": (1, 2, 66.67), "present": (2, 1, 33.33)}
    by = {(r.g, r.rule): r.failed for r in dq_metrics(df, rule_set, "d", ["g"]).collect()}
    assert by == {("a", "bound"): 1, ("a", "present"): 1, ("b", "bound"): 1, ("b", "present"): 0}
    empty = dq_metrics(df.where("false"), rule_set, "d").collect()
    assert {(r.passed, r.failed, r.failed_pct) for r in empty} == {(0, 0, None)}


def test_known_flag_never_repeats_rows(spark):
    df = spark.createDataFrame([("A",), ("X",), (None,)], "z string")
    keys = spark.createDataFrame([("A",), ("A",), (None,)], "zone_name string")
    got = {r.z: r._known_zone for r in flag_known(df, "z", keys, "zone_name").collect()}
    assert got == {"A": True, "X": False, None: False}


def test_unknown_and_retired_zones_are_quarantined(spark):
    zones = spark.createDataFrame([("A", "Zone A", True), ("B", "Zone B", False)], "zone_id string, zone_name string, is_current boolean")
    sources = {
        "contractor_a": spark.createDataFrame(
            [("1", "Zone A", "w", "2024-01-01", 5.0), ("2", "Zone B", "w", "2024-01-01", 5.0), ("3", "Zone A", "w", "n/a", 5.0)],
            "work_order_id string, site_location string, work_description string, date_completed string, cost_sgd double",
        ),
        "contractor_b": spark.createDataFrame(
            [("4", "Nowhere", "w", "2024-01-01", 5.0)], "WO_Number string, Location string, Desc string, CompletionDate string, Amount double"
        ),
        "contractor_c": spark.createDataFrame(
            [("5", "Zone A", "w", "2024-01-01", "SGD 7.50"), ("6", "Zone A", "w", "2024-01-01", "8.25"), ("7", "Zone A", "w", "2024-01-01", "SGD x")],
            "id string, loc_id string, notes string, completed_on string, charge string",
        ),
    }
    kept = {r.work_order_id: (r.contractor_source, r.cost) for r in contractors.works_orders(sources, zones, SETTINGS).collect()}
    assert kept == {"1": ("contractor_a", 5.0), "5": ("contractor_c", 7.5), "6": ("contractor_c", 8.25)}
    rejected = {r.work_order_id: r._quarantine_reason for r in contractors.works_orders_quarantine(sources, zones, SETTINGS).collect()}
    assert rejected == {
        "2": "valid_zone",
        "3": "valid_completion_date, valid_date_range",
        "4": "valid_zone",
        "7": "positive_cost, reasonable_cost",
    }
