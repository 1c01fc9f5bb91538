"""The numbers behind the dashboard widgets, from the contractor and spend marts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.functions.measures import money_percent, total


def contractor_kpis(contractor: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Orders, cost, and cost per order as sum over sum, overall or per dimension."""
    sums = contractor.groupBy(*by).agg(
        F.sum("work_order_count").alias("total_work_orders"), total("total_cost").alias("total_cost")
    )
    return sums.withColumn("avg_cost_per_order", F.try_divide("total_cost", "total_work_orders"))


def cost_trend(contractor: DataFrame) -> DataFrame:
    return contractor.groupBy("completion_month", "contractor_source").agg(total("total_cost").alias("total_cost"))


def orders_by_zone(contractor: DataFrame) -> DataFrame:
    return contractor.groupBy("zone", "contractor_source").agg(F.sum("work_order_count").alias("total_work_orders"))


def cost_matrix(contractor: DataFrame, contractors: Sequence[str]) -> DataFrame:
    """Zones down, contractors across. The contractors are named, so Spark need not look for them first."""
    return contractor.groupBy("zone").pivot("contractor_source", list(contractors)).agg(total("total_cost"))


def spend_kpis(spend: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return spend.groupBy(*by).agg(
        total("total_spend").alias("total_spend"), F.sum("line_item_count").alias("total_line_items")
    )


def spend_by_project(spend: DataFrame) -> DataFrame:
    return spend.groupBy("invoice_month", "project_code").agg(total("total_spend").alias("total_spend"))


def spend_rank(spend: DataFrame) -> DataFrame:
    """Zones by spend, the highest first."""
    return (
        spend.groupBy("site_zone")
        .agg(total("total_spend").alias("total_spend"))
        .orderBy(F.col("total_spend").desc(), "site_zone")
    )


def spend_share(spend: DataFrame) -> DataFrame:
    """Each project's share of its zone's spend, in percent. The window runs over zone-by-project sums."""
    sums = spend.groupBy("site_zone", "project_code").agg(total("total_spend").alias("total_spend"))
    zone_total = total("total_spend", Window.partitionBy("site_zone"))
    return sums.withColumn("_zone_total", zone_total).select(
        "site_zone", "project_code", "total_spend", money_percent("total_spend", "_zone_total").alias("share_pct")
    )


def sliced(
    mart: DataFrame, month_column: str, first: dt.date, last: dt.date, **choices: Sequence[str]
) -> DataFrame:
    """A mart cut to a month range and to chosen values of any dimensions."""
    mart = mart.where(F.col(month_column).between(F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp")))
    for column, values in choices.items():
        mart = mart.where(F.col(column).isin(list(values)))
    return mart
