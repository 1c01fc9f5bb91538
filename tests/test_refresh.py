"""From landing files to the scorecard: land twice, refresh, compare every table with SQL."""

import pytest
from pyspark.sql import functions as F

from sluiceway import config
from sluiceway.plans.refresh import daily_refresh
from sluiceway.queries.oracle import with_inputs
from sluiceway.queries.registry import SETTINGS, Inputs
from sluiceway.queries.streams import write_pages
from sluiceway.sources import schemas, tables
from sluiceway.streaming.landing import FOLDERS, land_all
from tests.compare import compare
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    """Landing files in two deliveries, a landing run after each, then the daily run."""
    base = tmp_path_factory.mktemp("lake")
    landing, lake = str(base / "landing"), str(base / "lake")
    inputs = Inputs(spark, SMALL)
    zones = tables.store(inputs.zones())
    bills = inputs.bills().select(*schemas.BILLS.names)
    records = inputs.invoice_records().drop(schemas.RESCUE).withColumn(
        "vendor", F.struct(F.col("vendor.id").cast("string").alias("id"), F.col("vendor.name").alias("name"))
    )
    metrics = []
    for early in (True, False):
        part = F.col("billing_period") < "1998-01-01"
        bills.where(part if early else ~part).write.mode("append").option("header", True).csv(f"{landing}/billing_customer")
        part = F.col("invoice_id") % 2 == 0
        write_pages(records.where(part if early else ~part), f"{landing}/finance_erp/{early}")
        kind = "pressure" if early else "flow"
        readings = inputs.readings().drop(schemas.RESCUE, "seq").where(F.col("reading_type") == kind)
        readings.write.mode("append").json(f"{landing}/network_telemetry")
        for letter in "abc":
            orders = inputs.works_orders()[f"contractor_{letter}"].drop(schemas.RESCUE)
            part = F.coalesce(F.col(orders.columns[0]).like("%-1"), F.lit(False))
            orders.where(part if early else ~part).write.mode("append").option("header", True).csv(f"{landing}/contractor_{letter}")
        bronze, counts = land_all(spark, landing, lake, zones)
        metrics.append(counts)
    return inputs, bronze, metrics, daily_refresh(bronze, lake, SETTINGS), land_all(spark, landing, lake, zones), lake


def test_landing_keeps_every_row(run):
    inputs, bronze, metrics, *_ = run
    assert bronze.bills.count() == inputs.bills().count()
    assert bronze.readings.count() == inputs.readings().count()
    assert bronze.invoices.count() == inputs.invoice_records().count()
    for name, landed in bronze.works_orders.items():
        assert landed.count() == inputs.works_orders()[name].count()
    assert bronze.readings.select("_row_id").distinct().count() == bronze.readings.count()


def test_landing_counts_rules_per_run(run):
    inputs, _, metrics, *_ = run
    total = metrics[0].unionByName(metrics[1]).groupBy("dataset", "rule").agg(F.sum("passed").alias("p"), F.sum("failed").alias("f"))
    got = {(r.dataset, r.rule): (r.p, r.f) for r in total.collect()}
    orders = inputs.works_orders()["contractor_a"]
    bad = orders.where("cost_sgd IS NULL OR cost_sgd <= 0").count()
    assert got["bronze.works_orders_a", "valid_cost"] == (orders.count() - bad, bad) and bad > 0
    assert len({d for d, _ in got}) == len(FOLDERS)


def test_a_landing_run_without_new_files_adds_nothing(run):
    _, bronze, _, _, (again, counts), _ = run
    assert again.bills.count() == bronze.bills.count() and counts.count() == 0


AS_TEXT = "SELECT * REPLACE (CAST(vendor_id AS VARCHAR) AS vendor_id) FROM headers"


@pytest.mark.parametrize(
    ("table", "sql"),
    [
        ("silver.billing_consumption", "SELECT * FROM consumption"),
        ("silver.customer_pii", "SELECT * FROM pii_history"),
        ("silver.finance_invoices", AS_TEXT),
        ("silver.invoice_line_items", "SELECT * FROM lines"),
        ("silver.works_orders", "SELECT * FROM orders_done"),
        ("silver.dim_location_zone", "SELECT * REPLACE (CAST(location_id AS VARCHAR) AS location_id) FROM locations"),
        ("gold.billing_by_zone_month", "SELECT * FROM billing_mart"),
        ("gold.spend_by_zone_month", "SELECT * FROM spend_mart"),
        ("gold.contractor_by_zone_month", "SELECT * FROM contractor_mart"),
        ("gold.network_health_diagnostic_by_zone_month", "SELECT * FROM network_mart"),
        ("gold.zone_performance_monthly", "SELECT * FROM scorecard"),
    ],
)
def test_tables_match_sql(run, duck, table, sql):
    assert compare(run[3][table], duck, with_inputs(sql)) == []


def test_no_row_is_lost(run):
    _, bronze, _, built, *_ = run
    orders = sum(df.count() for df in bronze.works_orders.values())
    assert built["silver.works_orders"].count() + built["silver.works_orders_quarantine"].count() == orders
    lines = bronze.invoices.select(F.explode("line_items")).count()
    assert built["silver.invoice_line_items"].count() + built["silver.invoice_line_items_quarantine"].count() == lines
    headers = bronze.invoices.select("invoice_id").distinct().count()
    assert built["silver.finance_invoices"].count() + built["silver.finance_invoices_quarantine"].count() == headers
    months = built["gold.zone_performance_monthly"].select("month_start_date").distinct().count()
    assert built["gold.zone_performance_monthly"].count() == months * bronze.zones.where("is_current").count()
    assert len(built) == 23, "fourteen silver and eight gold tables, and the rule counts"


def test_rule_counts_agree_with_the_tables(run):
    built = run[3]
    counts = {(r.dataset, r.rule): (r.passed, r.failed) for r in built["ops.rule_metrics"].collect()}
    rejected = built["silver.works_orders_quarantine"]
    unknown = rejected.where("_quarantine_reason LIKE '%valid_zone%'").count()
    total = built["silver.works_orders"].count() + rejected.count()
    assert counts["silver.works_orders", "valid_zone"] == (total - unknown, unknown) and unknown > 0
    marts = built["gold.billing_by_zone_month"]
    assert counts["gold.billing_by_zone_month", "valid_zone"] == (marts.count(), 0)
    assert {rule for d, rule in counts if d == "gold.zone_performance_monthly"} == {r.name for r in config.SCORECARD}


def test_a_second_run_rebuilds_the_same_tables_and_adds_to_the_history(run, spark):
    _, bronze, _, built, _, lake = run
    before = built["gold.zone_performance_monthly"].count()
    again = daily_refresh(bronze, lake, SETTINGS)
    assert again["gold.zone_performance_monthly"].count() == before
    assert again["ops.rule_metrics"].groupBy("dataset", "rule").count().where("count <> 2").count() == 0
