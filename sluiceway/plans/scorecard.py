"""The zone-by-month scorecard over the four marts."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway import config
from sluiceway.config import Settings
from sluiceway.functions.measures import difference, percent_of_amount, ratio, total, traffic_light
from sluiceway.operators import history
from sluiceway.operators.conform import union_all
from sluiceway.operators.resolve import months_since
from sluiceway.operators.rules import enforce

KEY = ["zone_name", "month_start_date"]


@dataclass(frozen=True)
class Marts:
    """The published marts the scorecard reads; give it stored tables, each is read twice."""

    billing: DataFrame
    spend: DataFrame
    contractor: DataFrame
    network: DataFrame

    def keyed(self) -> list[DataFrame]:
        """The marts under one spelling of the key; the two with a further dimension are rolled up."""
        billing = self.billing.select(
            F.col("service_zone").alias("zone_name"),
            "month_start_date",
            F.col("total_consumption").alias("total_consumption_m3"),
            F.col("total_billed").alias("total_billed_sgd"),
            "total_accounts",
            "overdue_count",
            "overdue_rate_pct",
        )
        network = self.network.select(
            F.col("zone").alias("zone_name"),
            "month_start_date",
            F.col("avg_pressure").alias("avg_pressure_bar"),
            F.col("avg_flow").alias("avg_flow_lpm"),
            F.col("reliability_pct").alias("telemetry_reliability_pct"),
        )
        return [billing, spend_rollup(self.spend), contractor_rollup(self.contractor), network]


def spend_rollup(spend: DataFrame) -> DataFrame:
    """Spend without the project."""
    month = F.col("invoice_month").cast("date").alias("month_start_date")
    return spend.groupBy(F.col("site_zone").alias("zone_name"), month).agg(
        total("total_spend").alias("total_invoice_spend_sgd"), F.sum("line_item_count").alias("invoice_line_count")
    )


def contractor_rollup(contractor: DataFrame) -> DataFrame:
    """Works orders without the contractor."""
    month = F.col("completion_month").cast("date").alias("month_start_date")
    return contractor.groupBy(F.col("zone").alias("zone_name"), month).agg(
        F.sum("work_order_count").alias("total_work_orders"), total("total_cost").alias("total_contractor_cost_sgd")
    )


def months_seen(marts: Marts) -> DataFrame:
    return union_all([mart.select("month_start_date") for mart in marts.keyed()]).distinct()


def spine(zones: DataFrame, months: DataFrame) -> DataFrame:
    """Every current zone in every month seen.

    The months, at most one value per calendar month, come in as one array from a scalar subquery
    and are exploded beside each zone: no cross join.
    """
    all_months = months.agg(F.sort_array(F.collect_set("month_start_date"))).scalar()
    kept = history.current(zones).select("zone_name", "region", "population_served", "sla_response_hours")
    return kept.select("*", F.explode(all_months).alias("month_start_date"))


def freshness(age: Column, sources: Column) -> Column:
    """How complete the month is for its age in months; a future month counts as recent."""
    recent = F.when(sources >= 3, "FRESH").when(sources >= 1, "PARTIAL").otherwise("STALE")
    late = F.when(sources >= 3, "FRESH").otherwise("INCOMPLETE")
    return F.when(age <= 1, recent).when(age <= 3, late).otherwise("HISTORICAL")


def with_kpis(joined: DataFrame, as_of: dt.date, processed_at: dt.datetime) -> DataFrame:
    spend, cost = F.col("total_invoice_spend_sgd"), F.col("total_contractor_cost_sgd")
    has_network = F.col("avg_pressure_bar").isNotNull() | F.col("avg_flow_lpm").isNotNull()
    available = [F.col("total_consumption_m3").isNotNull(), spend.isNotNull(), cost.isNotNull(), has_network]
    opex = difference(F.coalesce(spend, F.lit(0.0)), -F.coalesce(cost, F.lit(0.0)))
    first = joined.withColumns(
        {
            "total_opex_sgd": opex,
            "revenue_at_risk_sgd": percent_of_amount("overdue_rate_pct", "total_billed_sgd"),
            "consumption_per_capita_m3": ratio("total_consumption_m3", "population_served", 4),
            "network_reliability_flag": traffic_light("telemetry_reliability_pct", 50, 80),
            "data_sources_available": sum((a.cast("int") for a in available[1:]), available[0].cast("int")),
        }
    )
    second = first.withColumns(
        {
            "opex_per_m3": ratio("total_opex_sgd", "total_consumption_m3", 2),
            "cost_recovery_ratio": ratio("total_billed_sgd", "total_opex_sgd", 2),
            "opex_per_capita_sgd": ratio("total_opex_sgd", "population_served", 4),
            "data_freshness_flag": freshness(months_since(as_of, "month_start_date"), F.col("data_sources_available")),
            "refresh_timestamp": F.lit(processed_at).cast("timestamp"),
        }
    )
    return second.withColumn("cost_recovery_flag", traffic_light("cost_recovery_ratio", 0.8, 1.0))


def zone_performance(zones: DataFrame, marts: Marts, settings: Settings) -> DataFrame:
    """The 28-column scorecard. Zones that are not current do not appear."""
    joined = spine(zones, months_seen(marts))
    for mart in marts.keyed():
        joined = joined.join(mart, KEY, "left")
    scored = with_kpis(joined, settings.as_of, settings.processed_at).select(*config.SCORECARD_COLUMNS)
    return enforce(scored, config.SCORECARD)


def unscored_zones(zones: DataFrame, marts: Marts) -> DataFrame:
    """Zone names that a mart holds but the scorecard leaves out, with the number of mart rows."""
    named = union_all(
        [
            mart.groupBy("zone_name").agg(F.count(F.lit(1)).alias("mart_rows")).withColumn("mart", F.lit(name))
            for name, mart in zip(["billing", "spend", "contractor", "network"], marts.keyed())
        ]
    )
    return named.join(history.current(zones).select("zone_name"), "zone_name", "left_anti")
