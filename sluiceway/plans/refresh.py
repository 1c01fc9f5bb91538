"""The daily run: plain steps by domain, each writing one table that later steps read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway import config
from sluiceway.config import Settings
from sluiceway.operators.layout import cluster_rows, gather_rows
from sluiceway.operators.quarantine import bad_rows, good_rows, with_verdict
from sluiceway.operators.rules import DROP, Rule, metric_rows, observe, with_action
from sluiceway.plans import billing, contractors, finance, network, scorecard
from sluiceway.sources.tables import refuse_other_owner

METRICS = "dataset string, rule string, action string, passed long, failed long"


@dataclass(frozen=True)
class Bronze:
    """The landed inputs of one run; stored tables. ``row_id`` names a column that is unique per reading."""

    bills: DataFrame
    invoices: DataFrame
    works_orders: Mapping[str, DataFrame]
    readings: DataFrame
    zones: DataFrame
    row_id: str


class Lake:
    """Writes tables below one folder, clustered by their keys, and keeps the rule counts of each write.

    Tables are range-clustered; those as large as their sources are gathered by key instead, without a sampling pass. Several
    threads may publish at once.
    """

    def __init__(self, base: str, lanes: int):
        self.base = base
        self.lanes = lanes
        self.tables: dict[str, DataFrame] = {}
        self.metrics: list[tuple] = []

    def _write(
        self,
        name: str,
        df: DataFrame,
        cluster_by: Sequence[str],
        rule_set: Sequence[Rule],
        gather: bool,
        partition_by: Sequence[str] = (),
    ) -> DataFrame:
        path = f"{self.base}/{name.replace('.', '/')}"
        refuse_other_owner(df.sparkSession, path, streamed=False)
        placed = gather_rows(df, cluster_by, df.columns, self.lanes) if gather else cluster_rows(df, cluster_by, df.columns)
        if rule_set:
            placed, observation = observe(placed, rule_set)
        placed.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
        if rule_set:
            self.metrics.extend(metric_rows(rule_set, name, observation.get))
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def publish(
        self, name: str, df: DataFrame, cluster_by: Sequence[str], rule_set: Sequence[Rule] = (), gather: bool = False
    ) -> DataFrame:
        """Write a recomputed table; ``rule_set`` is counted on the way. ``gather`` is for tables as large as their source."""
        self.tables[name] = self._write(name, df, cluster_by, rule_set, gather)
        return self.tables[name]

    def publish_routed(
        self, name: str, df: DataFrame, cluster_by: Sequence[str], rule_set: Sequence[Rule], settings: Settings
    ) -> DataFrame:
        """Write good and rejected rows in one pass, partitioned by the verdict; returns the good ones."""
        routed = with_verdict(df, with_action(rule_set, DROP), settings.processed_at)
        table = self._write(name, routed, cluster_by, rule_set, True, ["_verdict"])
        self.tables[name], self.tables[f"{name}_quarantine"] = good_rows(table), bad_rows(table)
        return self.tables[name]


def refresh_billing(lake: Lake, bronze: Bronze, settings: Settings) -> DataFrame:
    bills = lake.publish(
        "silver.billing_consumption", billing.billing_consumption(bronze.bills), ["service_zone", "month_start_date"], gather=True
    )
    lake.publish("silver.customer_pii", billing.customer_pii(bronze.bills), ["account_id"], config.PII_VERSION, gather=True)
    rejected = billing.billing_quarantine(bronze.bills, settings)
    lake.publish("silver.quarantine_billing_consumption", rejected, ["quarantine_reason"], gather=True)
    lake.publish("silver.dq_metrics_billing_consumption", billing.billing_dq(bills, bronze.zones), ["rule"])
    mart = billing.billing_by_zone_month(bills)
    return lake.publish("gold.billing_by_zone_month", mart, ["service_zone", "month_start_date"], config.BILLING_MART)


def finance_marts(lake: Lake, lines: DataFrame, headers: DataFrame, settings: Settings) -> DataFrame:
    """Both spend marts; returns the one the scorecard reads."""
    by_category = finance.spend_by_zone_category_month(lines, headers, settings)
    lake.publish("gold.spend_by_zone_category_month", by_category, ["zone", "invoice_month"], config.CATEGORY_MART)
    mart = finance.spend_by_zone_month(lines, headers)
    return lake.publish("gold.spend_by_zone_month", mart, ["site_zone", "invoice_month"], config.SPEND_MART)


def refresh_finance(lake: Lake, bronze: Bronze, settings: Settings) -> DataFrame:
    headers = lake.publish_routed(
        "silver.finance_invoices",
        finance.incoming_invoices(bronze.invoices),
        ["site_zone", "invoice_date"],
        config.invoice_rules(settings),
        settings,
    )
    lines = lake.publish_routed(
        "silver.invoice_line_items", finance.incoming_lines(bronze.invoices), ["invoice_id"], config.LINE_HARD, settings
    )
    return finance_marts(lake, lines, headers, settings)


def contractor_marts(lake: Lake, orders: DataFrame) -> DataFrame:
    """Both works-order marts; returns the one the scorecard reads."""
    by_type = contractors.works_by_zone_type_month(orders)
    lake.publish("gold.works_by_zone_type_month", by_type, ["zone", "completion_month"], config.WORK_TYPE_MART)
    mart = contractors.contractor_by_zone_month(orders)
    return lake.publish("gold.contractor_by_zone_month", mart, ["zone", "completion_month"], config.CONTRACTOR_MART)


def refresh_contractors(lake: Lake, bronze: Bronze, settings: Settings) -> DataFrame:
    enriched = contractors.with_zone_id(contractors.conformed_orders(bronze.works_orders), bronze.zones, settings)
    orders = lake.publish_routed(
        "silver.works_orders", enriched, ["zone_id", "completion_date"], config.works_rules(settings), settings
    )
    return contractor_marts(lake, orders)


def network_marts(lake: Lake, readings: DataFrame, locations: DataFrame) -> DataFrame:
    """Both network marts and the soft checks; returns the mart the scorecard reads."""
    lake.publish("silver.dq_metrics_network_telemetry", network.telemetry_dq(readings), ["rule"])
    health = network.network_health(readings, locations)
    lake.publish("gold.network_health_by_zone_month", health, ["zone", "month_start_date"], config.NETWORK_MART)
    return lake.publish(
        "gold.network_health_diagnostic_by_zone_month",
        network.network_diagnostic(readings, locations),
        ["zone", "month_start_date"],
        config.NETWORK_DIAGNOSTIC_MART,
    )


def refresh_network(lake: Lake, bronze: Bronze, settings: Settings) -> DataFrame:
    locations = lake.publish("silver.dim_location_zone", network.location_zone(bronze.readings, settings), ["location_id"])
    flagged = network.telemetry(bronze.readings, locations, settings, bronze.row_id)
    readings = lake.publish("silver.network_telemetry", flagged, ["location_id", "month_start_date"], gather=True)
    rejected = network.telemetry_quarantine(bronze.readings, settings)
    lake.publish("silver.quarantine_network_telemetry", rejected, ["quarantine_reason"], gather=True)
    return network_marts(lake, readings, locations)


def publish_scorecard(lake: Lake, zones: DataFrame, marts: scorecard.Marts, settings: Settings) -> DataFrame:
    """The scorecard over stored marts, each the newest there is; it waits for none of them."""
    built = scorecard.zone_performance(zones, marts, settings)
    return lake.publish("gold.zone_performance_monthly", built, ["zone_name", "month_start_date"], config.SCORECARD)


def keep_metrics(lake: Lake, spark: SparkSession, settings: Settings) -> DataFrame:
    """Append the run's rule counts to the history for spike reports."""
    stamp = F.lit(settings.processed_at).cast("timestamp")
    history = spark.createDataFrame(sorted(lake.metrics), METRICS).withColumn("run_at", stamp)
    history.coalesce(1).write.mode("append").parquet(f"{lake.base}/ops/rule_metrics")
    return spark.read.parquet(f"{lake.base}/ops/rule_metrics")


def daily_refresh(bronze: Bronze, base: str, settings: Settings) -> dict[str, DataFrame]:
    """Rebuild every silver and gold table below ``base``; returns the tables by name.

    The four domains do not read each other and run side by side; the scorecard follows.
    """
    lake = Lake(base, settings.lanes)
    spark = bronze.zones.sparkSession
    domains = {"billing": refresh_billing, "spend": refresh_finance, "contractor": refresh_contractors, "network": refresh_network}
    with ThreadPoolExecutor(len(domains)) as pool:
        running = {name: pool.submit(refresh, lake, bronze, settings) for name, refresh in domains.items()}
        marts = scorecard.Marts(**{name: job.result() for name, job in running.items()})
    publish_scorecard(lake, bronze.zones, marts, settings)
    return {**lake.tables, "ops.rule_metrics": keep_metrics(lake, spark, settings)}
