"""Bills and personal details on small hand-made tables."""

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluiceway import config
from sluiceway.config import Settings
from sluiceway.functions.masking import masked_view
from sluiceway.operators import history
from sluiceway.plans import billing

BRONZE = (
    "account_id string, meter_id string, billing_period date, service_zone string, consumption_value double, "
    "consumption_unit string, amount_billed double, payment_status string, customer_name string, address string, contact_number string"
)
SETTINGS = Settings(as_of=dt.date(2024, 6, 1), processed_at=dt.datetime(2024, 6, 1), lanes=4)


def bill(account="a", meter="m", day=1, value=10.0, unit="m3", amount=5.0, status="PAID", zone="Z", name="N", address="S", contact="1", month=1):
    return (account, meter, dt.date(2024, month, day), zone, value, unit, amount, status, name, address, contact)


def bills(spark, *rows):
    return spark.createDataFrame(list(rows), BRONZE)


def test_units_and_status_codes(spark):
    df = bills(
        spark,
        bill("1", unit="l", value=2500.0, status="Paid"),
        bill("2", unit="L", value=1000.0, status="PEND"),
        bill("3", unit="m3", status="os"),
        bill("4", unit=None, status="xyz"),
        bill("5", status=None, amount=-3.0, value=-44.0),
        bill("6", status="Outstanding"),
    )
    got = {r.account_id: (r.consumption_m3, r.payment_status) for r in billing.billing_consumption(df).collect()}
    assert got == {
        "1": (2.5, "paid"), "2": (1.0, "pending"), "3": (10.0, "overdue"),
        "4": (10.0, "xyz"), "5": (-44.0, None), "6": (10.0, "overdue"),
    }


def test_invalid_first_bill_takes_the_later_one_down(spark):
    df = bills(spark, bill(day=1, amount=None), bill(day=2), bill(day=3, month=2))
    assert [r.billing_period.month for r in billing.billing_consumption(df).collect()] == [2]
    assert sorted(r.billing_period.day for r in billing.billing_consumption(df, valid_first=True).collect()) == [2, 3]
    superseded = billing.superseded_bills(df, SETTINGS).collect()
    assert [(r.billing_period.month, r.billing_period.day) for r in superseded] == [(1, 2)]
    assert [r.quarantine_reason for r in billing.billing_quarantine(df, SETTINGS).collect()] == ["missing amount_billed"]


def test_text_that_is_no_number_is_kept_by_input_rules_only(spark):
    df = bills(spark, bill()).withColumn("consumption_value", F.lit("n/a"))
    assert [r.consumption_m3 for r in billing.billing_consumption(df).collect()] == [None]
    assert billing.billing_consumption_output_rules(df).count() == 0


def test_overdue_rate_can_pass_one_hundred(spark):
    df = bills(spark, bill(meter="1", status="OS"), bill(meter="2", status="OS"), bill(meter="3", status="OS"), bill("b"))
    row = billing.billing_by_zone_month(billing.billing_consumption(df)).collect()[0]
    assert (row.total_accounts, row.overdue_count, row.overdue_rate_pct) == (2, 3, 150.0)


def test_rate_is_rounded_half_up(spark):
    rows = [bill(f"a{i}", status="OS" if i < 1 else "PAID") for i in range(8)]
    row = billing.billing_by_zone_month(billing.billing_consumption(bills(spark, *rows))).collect()[0]
    assert row.overdue_rate_pct == 12.5


def versions(spark, rows, **options):
    df = billing.customer_pii(bills(spark, *rows), **options).collect()
    rows_ = [(r.account_id, r.customer_name, r.address, r.contact_number, r.effective_from, r.effective_to, r.is_current) for r in df]
    return sorted(rows_, key=lambda v: (v[0], v[4]))


def day(n):
    return dt.date(2024, 1, n)


def test_versions(spark):
    rows = [
        bill("one", day=1),
        bill("same", day=1), bill("same", day=5),
        bill("moved", day=1), bill("moved", day=5, address="T"), bill("moved", day=9, address="T"),
        bill(None, day=2),
    ]
    assert versions(spark, rows) == [
        ("moved", "N", "S", "1", day(1), day(4), False),
        ("moved", "N", "T", "1", day(5), None, True),
        ("one", "N", "S", "1", day(1), None, True),
        ("same", "N", "S", "1", day(1), None, True),
    ]


def test_change_to_and_from_null(spark):
    rows = [bill(day=1), bill(day=2, address=None), bill(day=3)]
    assert [v[4] for v in versions(spark, rows)] == [day(1), day(2), day(3)]
    assert [v[4] for v in versions(spark, rows, null_safe=False)] == [day(1)]


def test_missing_name_always_counts_when_comparing_plainly(spark):
    rows = [bill(day=1, name=None), bill(day=2, name=None)]
    assert [v[4] for v in versions(spark, rows)] == [day(1)]
    assert [v[4] for v in versions(spark, rows, null_safe=False)] == [day(1), day(2)]


def test_two_meters_on_one_day_give_one_version(spark):
    rows = [bill(meter="1", day=1, address="A"), bill(meter="2", day=1, address="B"), bill(day=2, address="B")]
    assert versions(spark, rows) == [("a", "N", "B", "1", day(1), None, True)]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("xy"), st.integers(1, 9), st.sampled_from([None, "A", "B"])), max_size=25))
def test_versions_against_brute_force(spark, data):
    rows = [bill(account, day=n, address=address) for account, n, address in data]
    by_day = defaultdict(dict)
    for account, n, address in data:
        kept = by_day[account].get(n)
        by_day[account][n] = address if kept is None else max(kept, address or "")
    expected = []
    for account, days in by_day.items():
        starts = []
        for n in sorted(days):
            if not starts or starts[-1][1] != days[n]:
                starts.append((n, days[n]))
        for i, (n, address) in enumerate(starts):
            end = day(starts[i + 1][0] - 1) if i + 1 < len(starts) else None
            expected.append((account, "N", address, "1", day(n), end, end is None))
    key = lambda v: (v[0], v[4])
    df = billing.customer_pii(bills(spark, *rows)).collect()
    got = [(r.account_id, r.customer_name, r.address, r.contact_number, r.effective_from, r.effective_to, r.is_current) for r in df]
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert history.version_faults(billing.customer_pii(bills(spark, *rows)), "account_id").count() == 0


def test_version_faults(spark):
    schema = "k string, effective_from date, effective_to date, is_current boolean"
    df = spark.createDataFrame(
        [
            ("ok", day(1), day(4), False), ("ok", day(5), None, True),
            ("overlap", day(1), day(5), False), ("overlap", day(5), None, True),
            ("two", day(1), None, True), ("two", day(5), None, True),
            ("none", day(1), day(4), False),
            ("inverted", day(4), day(1), False), ("inverted", day(5), None, True),
            ("copy", day(1), None, True), ("copy", day(1), None, True), ("copy", day(1), None, True),
        ],
        schema,
    )
    got = {r.k: (r.version_count, r.current_count, r.overlap_count, r.inverted_count) for r in history.version_faults(df, "k").collect()}
    assert got == {
        "overlap": (2, 1, 1, 0), "two": (2, 2, 1, 0), "none": (1, 0, 0, 0), "inverted": (2, 1, 0, 1), "copy": (3, 3, 2, 0),
    }


def test_details_as_of_a_day(spark):
    versions_ = spark.createDataFrame(
        [("a", "X", day(3), day(5)), ("a", "Y", day(6), day(8))], "k string, address string, effective_from date, effective_to date"
    )
    facts = spark.createDataFrame([("a", day(n), n) for n in (1, 3, 5, 6, 6, 9)] + [("b", day(4), 0)], "k string, d date, n int")
    got = sorted((r.n, r.address) for r in history.as_of_version(facts, versions_, "k", "d", ["address"]).collect())
    assert got == [(3, "X"), (5, "X"), (6, "Y"), (6, "Y")]


def test_masking_follows_the_tags(spark):
    pii = billing.customer_pii(bills(spark, bill(address=None)))
    hidden = masked_view(pii, config.PII_TAGS, groups=["analysts"]).collect()[0]
    assert [hidden[c] for c in config.PII_COLUMNS] == ["***MASKED***"] * 3
    assert hidden.account_id == "a"
    shown = masked_view(pii, config.PII_TAGS, groups=[config.PII_UNMASK_GROUP]).collect()[0]
    assert (shown.customer_name, shown.address) == ("N", None)
    assert masked_view(pii, {"sensitivity": "pii", "domain": "finance"}, groups=[]).collect()[0].customer_name == "N"


def test_facts_carry_no_personal_detail(spark):
    assert not set(config.PII_COLUMNS) & set(billing.billing_consumption(bills(spark, bill())).columns)


def test_snapshot_diff(spark):
    old = spark.createDataFrame([("same", 1, None), ("gone", 1, "x"), ("changed", 1, None)], "k string, v int, w string")
    new = spark.createDataFrame([("same", 1, None), ("changed", 1, "y"), ("new", 2, "z")], "k string, v int, w string")
    got = sorted((r._change_type, r.k, r.v, r.w) for r in history.snapshot_diff(old, new, "k").collect())
    assert got == [
        ("delete", "gone", 1, "x"),
        ("insert", "new", 2, "z"),
        ("update_postimage", "changed", 1, "y"),
        ("update_preimage", "changed", 1, None),
    ]
