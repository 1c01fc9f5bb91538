"""Invoices, readings and the scorecard on small hand-made tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluiceway.config import Settings
from sluiceway.functions import conforming as c
from sluiceway.functions import measures as m
from sluiceway.operators import resolve
from sluiceway.plans import finance, network, reports, scorecard
from sluiceway.sources.files import with_row_id
from sluiceway.sources.schemas import INVOICE

SETTINGS = Settings(as_of=dt.date(2024, 6, 1), processed_at=dt.datetime(2024, 6, 1), lanes=4)


def invoice(number, date="2024-03-05", currency="SGD", project="P1", lines=((1, "Labour", 2, 10.0),), zone="Zone A - North", vendor=("v", "V")):
    return (number, date, "CC", currency, zone, project, vendor, lines)


def invoices(spark, *rows):
    return spark.createDataFrame(list(rows), INVOICE)


def test_invoice_edges(spark):
    records = invoices(
        spark, invoice("1"), invoice("1"), invoice("2", currency=""), invoice("3", currency="USD"), invoice("4", currency=None),
        invoice("5", date="n/a"), invoice("6", date="2019-12-31"), invoice("7", date="2024-06-02"), invoice("8", project=None),
        invoice("9", zone="", vendor=None),
    )
    assert sorted(r.invoice_id for r in finance.invoices(records, SETTINGS).collect()) == ["1", "8"]
    reasons = {r.invoice_id: r._quarantine_reason for r in finance.invoices_quarantine(records, SETTINGS).collect()}
    assert reasons == {
        "2": "valid_currency", "3": "valid_currency", "4": "valid_currency",
        "5": "valid_invoice_date, valid_invoice_date_range",
        "6": "valid_invoice_date_range", "7": "valid_invoice_date_range",
        "9": "valid_site_zone, valid_vendor_id, has_vendor_name",
    }


def test_line_edges(spark):
    lines = ((1, "L", 0, 5.0), (2, "L", -1, 5.0), (3, "L", None, 5.0), (4, None, 1, 5.0), (5, "L", 3, 1.1), (0, "L", 1, 1.0))
    records = invoices(spark, invoice("1", lines=lines), invoice("2", lines=None), invoice("3", lines=()))
    kept = finance.line_items(records).collect()
    assert [(r.line_no, r.qty, r.line_total) for r in kept] == [(5, 3, 3 * 1.1)]
    reasons = {r.line_no: r._quarantine_reason for r in finance.line_items_quarantine(records, SETTINGS).collect()}
    assert reasons == {
        1: "positive_qty, valid_line_total", 2: "positive_qty, valid_line_total", 3: "positive_qty, valid_line_total",
        4: "valid_description", 0: "valid_line_no",
    }


def test_lines_of_a_repeated_export_count_twice_unless_told_otherwise(spark):
    records = invoices(spark, invoice("1"), invoice("1"))
    headers = finance.invoices(records, SETTINGS)
    spend = lambda once: finance.spend_by_zone_month(finance.line_items(records, once), headers).collect()[0].total_spend
    assert (spend(False), spend(True)) == (40.0, 20.0)


def test_spend_buckets_and_codes(spark):
    lines = ((1, "Labour", 2, 10.0), (2, "Permit", 1, 5.0), (3, "Labour", 1, 4.0))
    records = invoices(spark, invoice("1", lines=lines), invoice("2", project=None, date="2024-03-31"))
    headers, items = finance.invoices(records, SETTINGS), finance.line_items(records)
    spend = {r.project_code: (r.invoice_month, r.total_spend, r.line_item_count) for r in finance.spend_by_zone_month(items, headers).collect()}
    march = dt.datetime(2024, 3, 1)
    assert spend == {"P1": (march, 29.0, 3), "OPEX-UNALLOCATED": (march, 20.0, 1)}
    by_category = finance.spend_by_zone_category_month(items, headers, SETTINGS).collect()
    assert {r.cost_category: (r.zone_id, r.total_spend, r.line_count, r.avg_unit_cost) for r in by_category} == {
        "Labour": ("A", 44.0, 3, 8.0),
        "Permit": ("A", 5.0, 1, 5.0),
    }


READINGS = "sensor_id string, location_id string, zone string, timestamp string, reading_type string, reading_value double"


def reading(location="l", zone="A", ts="2024-01-01 00:00:00", kind="flow", value=1.0, sensor="s"):
    return (sensor, location, zone, ts, kind, value)


def readings(spark, *rows):
    return spark.createDataFrame(list(rows), READINGS)


def test_vote_threshold_and_ties(spark):
    rows = [reading("at80", "A")] * 4 + [reading("at80", "B")]
    rows += [reading("below", "A")] * 7999 + [reading("below", "B")] * 2001
    rows += [reading("tie", "B"), reading("tie", "A"), reading("nulltie", None), reading("nulltie", "Z"), reading(None, "A")]
    got = {r.location_id: (r.resolved_zone, r.confidence_pct, r.is_ambiguous) for r in network.location_zone(readings(spark, *rows), SETTINGS).collect()}
    assert got == {"at80": ("A", 80.0, False), "below": ("A", 79.99, True), "tie": ("A", 50.0, True), "nulltie": ("Z", 50.0, True)}


def test_unnamed_zone_can_win_and_stops_the_run(spark):
    df = readings(spark, reading("l", None), reading("l", None), reading("l", "A"))
    with pytest.raises(Exception, match="valid_resolved_zone"):
        network.location_zone(df, SETTINGS).collect()


def test_votes_merge_batch_by_batch(spark):
    first, second = readings(spark, reading("l", "A"), reading("m", "B")), readings(spark, reading("l", "B"), reading("l", "B"))
    parts = resolve.merge_votes(resolve.votes(first, "location_id", "zone"), resolve.votes(second, "location_id", "zone"), "location_id", "zone")
    whole = resolve.votes(first.unionByName(second), "location_id", "zone")
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole.collect()))


LOCATIONS = "location_id string, resolved_zone string, confidence_pct double, is_ambiguous boolean"


def test_reading_flags(spark):
    locations = spark.createDataFrame([("l", "A", 100.0, False), ("u", "A", 60.0, True)], LOCATIONS)
    df = with_row_id(readings(
        spark,
        reading(value=1.0), reading(value=2.0, kind="pressure"),
        reading(ts="2024-01-01 01:00:00", zone="B"), reading(ts="2024-01-01 02:00:00", zone=None),
        reading("u", ts="2024-01-01 03:00:00"), reading("new", ts="2024-01-01 04:00:00"), reading(None, ts="2024-01-01 05:00:00"),
        reading(ts="bad"), reading(value=None), reading(sensor=None),
    ))
    got = sorted((r.reading_ts.hour, r.reading_value, r.is_duplicate, r.zone_is_uncertain) for r in network.telemetry(df, locations, SETTINGS, "_row_id").collect())
    assert got == [
        (0, 1.0, False, False), (0, 2.0, True, False),  # pressure and flow at one instant share the key
        (1, 1.0, False, True),  # the reading disagrees
        (2, 1.0, False, False),  # a reading without a zone does not disagree
        (3, 1.0, False, True), (4, 1.0, False, True), (5, 1.0, False, True),
    ]
    reasons = sorted(r.quarantine_reason for r in network.telemetry_quarantine(df, SETTINGS).collect())
    assert reasons == ["missing or unparseable timestamp", "missing reading_value", "missing sensor_id"]


def test_trusted_mart_trusts_the_location(spark):
    locations = spark.createDataFrame([("l", "A", 90.0, False), ("u", "B", 60.0, True)], LOCATIONS)
    df = readings(spark, reading(zone="X", value=4.0), reading("u", value=9.0, ts="2024-01-01 01:00:00"), reading("u", value=9.0, ts="2024-01-01 01:00:00"))
    telemetry = network.telemetry(with_row_id(df), locations, SETTINGS, "_row_id")
    health = network.network_health(telemetry, locations).collect()
    assert [(r.zone, r.avg_flow, r.avg_pressure, r.reading_count) for r in health] == [("A", 4.0, None, 1)]
    diagnostic = {r.zone: (r.total_readings, r.reliable_readings, r.reliability_pct, r.duplicate_count, r.zone_uncertain_count)
                  for r in network.network_diagnostic(telemetry, locations).collect()}
    assert diagnostic == {"A": (1, 0, 0.0, 0, 1), "B": (2, 0, 0.0, 1, 2)}


def marts(spark, billing=(), spend=(), contractor=(), network_rows=()):
    return scorecard.Marts(
        billing=spark.createDataFrame(list(billing), "service_zone string, month_start_date date, total_consumption double, total_billed double, total_accounts long, overdue_count long, overdue_rate_pct double"),
        spend=spark.createDataFrame(list(spend), "site_zone string, project_code string, invoice_month timestamp, total_spend double, line_item_count long"),
        contractor=spark.createDataFrame(list(contractor), "zone string, contractor_source string, completion_month timestamp, work_order_count long, total_cost double"),
        network=spark.createDataFrame(list(network_rows), "zone string, month_start_date date, avg_pressure double, avg_flow double, total_readings long, reliable_readings long, reliability_pct double, duplicate_count long, zone_uncertain_count long"),
    )


ZONES = "zone_id string, zone_name string, region string, population_served int, sla_response_hours int, is_current boolean"


def zones(spark):
    return spark.createDataFrame([("A", "A", "r", 1000, 4, True), ("B", "B", "r", 0, 4, True), ("C", "C", "r", 10, 4, False)], ZONES)


def month(n, year=2024):
    return dt.date(year, n, 1)


def test_scorecard(spark):
    built = scorecard.zone_performance(
        zones(spark),
        marts(
            spark,
            billing=[("A", month(5), 100.0, 80.0, 4, 1, 25.0), ("C", month(5), 1.0, 1.0, 1, 0, 0.0), ("A", month(4), 10.0, 100.0, 1, 0, 0.0)],
            spend=[("A", "P1", dt.datetime(2024, 5, 1), 60.0, 2), ("A", "P2", dt.datetime(2024, 5, 1), 40.005, 1), ("A", "P", dt.datetime(2024, 4, 1), 100.0, 1)],
            contractor=[("A", "x", dt.datetime(2024, 1, 1), 1, 7.0)],
            network_rows=[("A", month(5), None, 3.0, 1, 1, 50.0, 0, 0), ("B", month(5), 1.0, 1.0, 1, 1, 80.0, 0, 0)],
        ),
        SETTINGS,
    )
    rows = {(r.zone_name, r.month_start_date.month): r for r in built.collect()}
    assert set(rows) == {(z, n) for z in "AB" for n in (1, 4, 5)}
    may = rows["A", 5]
    assert (may.total_invoice_spend_sgd, may.total_opex_sgd, may.invoice_line_count) == (100.005, 100.005, 3), "sums are not rounded on the way"
    assert (may.opex_per_m3, may.revenue_at_risk_sgd, may.cost_recovery_ratio) == (1.0, 20.0, 0.8)
    assert (may.consumption_per_capita_m3, may.opex_per_capita_sgd) == (0.1, 0.1)
    assert (may.cost_recovery_flag, may.network_reliability_flag, may.data_sources_available) == ("AMBER", "AMBER", 3)
    assert may.data_freshness_flag == "FRESH"
    april = rows["A", 4]
    assert (april.cost_recovery_ratio, april.cost_recovery_flag, april.data_freshness_flag) == (1.0, "GREEN", "INCOMPLETE")
    empty = rows["B", 4]
    assert (empty.total_opex_sgd, empty.cost_recovery_ratio, empty.cost_recovery_flag, empty.opex_per_capita_sgd) == (0.0, None, None, None)
    assert rows["B", 5].network_reliability_flag == "GREEN" and rows["B", 5].data_freshness_flag == "PARTIAL"
    assert rows["A", 1].data_freshness_flag == "HISTORICAL"
    assert list(built.columns) == scorecard.config.SCORECARD_COLUMNS
    left_out = scorecard.unscored_zones(zones(spark), marts(spark, billing=[("C", month(5), 1.0, 1.0, 1, 0, 0.0)])).collect()
    assert [(r.mart, r.zone_name, r.mart_rows) for r in left_out] == [("billing", "C", 1)]


@pytest.mark.parametrize(
    ("start", "sources", "flag"),
    [
        (month(7), 0, "STALE"), (month(7), 1, "PARTIAL"), (month(6), 3, "FRESH"), (month(5), 2, "PARTIAL"),
        (month(4), 2, "INCOMPLETE"), (month(3), 3, "FRESH"), (month(2), 4, "HISTORICAL"), (month(12, 2025), 0, "STALE"),
    ],
)
def test_freshness(spark, start, sources, flag):
    df = spark.createDataFrame([(start, sources)], "m date, n int")
    got = df.select(scorecard.freshness(resolve.months_since(SETTINGS.as_of, "m"), scorecard.F.col("n")).alias("f")).collect()
    assert got[0].f == flag


def test_totals_and_means_below_a_cent_are_kept(spark):
    df = spark.createDataFrame([(0.004,), (0.1,), (0.2,), (None,)], "v double")
    assert df.where("v < 0.01").select(m.total("v"), m.mean("v")).first() == (0.004, 0.004)
    assert df.select(m.total("v"), m.mean("v")).first() == (0.304, 0.304 / 3)
    parts = df.withColumn("g", F.when(F.col("v") < 0.15, 1).otherwise(2)).groupBy("g").agg(m.total("v").alias("s"))
    assert parts.select(m.total("s")).first()[0] == 0.304


def test_rounding_is_half_up_on_decimals(spark):
    df = spark.createDataFrame([(1.005, 1.0), (12345.0, 100000.0), (1.0, 0.0), (-1.0, 3.0)], "a double, b double")
    assert [r[0] for r in df.select(m.ratio("a", "b", 2)).collect()] == [1.01, 0.12, None, -0.33]
    assert df.select(m.ratio("a", "b", 4)).collect()[1][0] == 0.1235


def test_conforming_never_raises(spark):
    df = spark.createDataFrame([("x", "2024-13-01", "SGD 1,2"), (None, None, None), ("7", "2024-02-29", "SGD 12.50")], "n string, d string, g string")
    got = df.select(c.number("n").alias("n"), c.text_to_date("d").alias("d"), c.text_to_timestamp("d").alias("t"), c.charge_amount("g").alias("g")).collect()
    assert [tuple(r) for r in got] == [
        (None, None, None, None), (None, None, None, None), (7.0, dt.date(2024, 2, 29), dt.datetime(2024, 2, 29), 12.5),
    ]


def test_spikes(spark):
    rows = [("d", "r", month(n), 10, 1, 1.0) for n in range(1, 12)] + [("d", "r", month(12), 10, 9, 50.0)]
    df = spark.createDataFrame(rows, "dataset string, rule string, month date, passed long, failed long, failed_pct double")
    assert [r.month for r in reports.reject_spikes(df, "month", 2.0).collect() if r.is_spike] == [month(12)]
    flat = df.where("failed_pct = 1.0")
    assert not any(r.is_spike for r in reports.reject_spikes(flat, "month", 2.0).collect())
