"""Reports asked for beside the marts: integrity, spikes, trends, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.functions.conforming import is_known_status
from sluiceway.functions.measures import difference, money_percent, total
from sluiceway.plans.scorecard import KEY, contractor_rollup, spend_rollup


def orphan_lines(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Invoices that have lines but no header, with the number and value of their lines.

    Lines are counted per invoice first, so the anti-join meets one row per invoice.
    """
    per_invoice = lines.groupBy("invoice_id").agg(
        F.count(F.lit(1)).alias("line_count"), total("line_total").alias("line_value")
    )
    return per_invoice.join(headers.select("invoice_id"), "invoice_id", "left_anti")


def unknown_status(bronze: DataFrame, codes: dict[str, list[str]] | None = None) -> DataFrame:
    """Status codes that no code list names, with their count."""
    unknown = bronze.where(F.col("payment_status").isNotNull() & ~is_known_status("payment_status", codes))
    return unknown.groupBy(F.lower("payment_status").alias("payment_status")).agg(F.count(F.lit(1)).alias("bills"))


def reject_spikes(metrics: DataFrame, period: str, limit: float) -> DataFrame:
    """Periods in which a rule's failure rate lies ``limit`` standard deviations above its mean.

    The window runs over one row per rule and period.
    """
    history = Window.partitionBy("dataset", "rule")
    mean, deviation = F.avg("failed_pct").over(history), F.stddev_pop("failed_pct").over(history)
    scored = metrics.withColumns({"_mean": mean, "_deviation": deviation})
    z = F.round(F.try_divide(F.col("failed_pct") - F.col("_mean"), F.round("_deviation", 9)), 3)
    is_spike = F.coalesce(z > limit, F.lit(False))
    return scored.select(
        "dataset", "rule", period, "failed", "failed_pct", z.alias("z_score"), is_spike.alias("is_spike")
    )


def month_over_month(mart: DataFrame, zone: str, month: str, measure: str) -> DataFrame:
    """A measure per zone and month, the month before, and the change. One row per month enters the window."""
    monthly = mart.groupBy(F.col(zone).alias("zone"), F.col(month).cast("date").alias("month_start_date")).agg(
        total(measure).alias("current_value")
    )
    before = F.lag("current_value").over(Window.partitionBy("zone").orderBy("month_start_date"))
    compared = monthly.withColumn("previous_value", before)
    change = difference("current_value", "previous_value")
    return compared.withColumn("change", change).withColumn("change_pct", money_percent("change", "previous_value"))


def contractor_against_invoices(contractor: DataFrame, spend: DataFrame) -> DataFrame:
    """Contractor cost beside invoice spend of the same zone and month; either may be missing."""
    both = contractor_rollup(contractor).join(spend_rollup(spend), KEY, "full_outer")
    gap = difference(*(F.coalesce(c, F.lit(0.0)) for c in ("total_contractor_cost_sgd", "total_invoice_spend_sgd")))
    return both.select(
        *KEY, "total_contractor_cost_sgd", "total_invoice_spend_sgd", gap.alias("cost_minus_invoices")
    )


def year_to_date(spend: DataFrame) -> DataFrame:
    """Running spend per zone within the year; at most twelve rows enter each window."""
    monthly = spend_rollup(spend).select(*KEY, "total_invoice_spend_sgd")
    running = Window.partitionBy("zone_name", F.year("month_start_date")).orderBy("month_start_date")
    return monthly.withColumn("ytd_spend_sgd", total("total_invoice_spend_sgd", running))


def alerts(mart: DataFrame, breach: Column) -> DataFrame:
    """Rows of a mart that pass a limit."""
    return mart.where(F.coalesce(breach, F.lit(False)))
