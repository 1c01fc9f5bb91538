"""Supplier invoices: headers, lines, quarantines, two spend marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway import config
from sluiceway.config import Settings
from sluiceway.functions import conforming as c
from sluiceway.functions.measures import mean, total
from sluiceway.operators.conform import explode_records
from sluiceway.operators.dedup import keep_first
from sluiceway.operators.quarantine import quarantine
from sluiceway.operators.rules import DROP, enforce, keep_valid, with_action

HEADER = ["invoice_id", "cost_center", "vendor_id", "vendor_name", "site_zone", "currency", "invoice_date", "project_code"]


def flatten_headers(records: DataFrame) -> DataFrame:
    """Header columns with the vendor flattened and the date parsed. Works on streams."""
    return records.select(
        "invoice_id",
        "cost_center",
        F.col("vendor.id").alias("vendor_id"),
        F.col("vendor.name").alias("vendor_name"),
        "site_zone",
        "currency",
        c.text_to_date("invoice_date").alias("invoice_date"),
        "project_code",
    )


def incoming_invoices(records: DataFrame) -> DataFrame:
    """One header per invoice id; pages repeat invoices. Ties are settled on every column."""
    return keep_first(flatten_headers(records), ["invoice_id"], HEADER[1:])


def invoices(records: DataFrame, settings: Settings) -> DataFrame:
    return keep_valid(incoming_invoices(records), with_action(config.invoice_rules(settings), DROP))


def invoices_quarantine(records: DataFrame, settings: Settings) -> DataFrame:
    return quarantine(
        incoming_invoices(records), with_action(config.invoice_rules(settings), DROP), settings.processed_at
    )


def incoming_lines(records: DataFrame) -> DataFrame:
    """One row per line; types are forced before the total is taken. Lines are not deduplicated."""
    lines = explode_records(records, "line_items", ["invoice_id"])
    typed = lines.select(
        "invoice_id",
        c.whole_number("line_no").alias("line_no"),
        "description",
        c.whole_number("qty").alias("qty"),
        c.number("unit_cost").alias("unit_cost"),
    )
    return typed.withColumn("line_total", F.col("qty") * F.col("unit_cost"))


def line_items(records: DataFrame, once: bool = False) -> DataFrame:
    """Valid lines. ``once`` keeps one row per invoice and line number, for sources that export again."""
    lines = incoming_lines(records)
    if once:
        lines = keep_first(lines, ["invoice_id", "line_no"], ["description", "qty", "unit_cost"])
    return keep_valid(lines, config.LINE_HARD)


def line_items_quarantine(records: DataFrame, settings: Settings) -> DataFrame:
    return quarantine(incoming_lines(records), config.LINE_HARD, settings.processed_at)


def spend_by_zone_month(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Spend by zone, project and month.

    Lines are summed per invoice first, with map-side partials: the join then meets one row per
    invoice, however many lines one invoice has.
    """
    per_invoice = lines.groupBy("invoice_id").agg(
        total("line_total").alias("spend"), F.count(F.lit(1)).alias("line_count")
    )
    mart = (
        per_invoice.join(headers.select("invoice_id", "site_zone", "project_code", "invoice_date"), "invoice_id")
        .groupBy(
            "site_zone",
            c.named_bucket("project_code").alias("project_code"),
            c.month_instant("invoice_date").alias("invoice_month"),
        )
        .agg(total("spend").alias("total_spend"), F.sum("line_count").alias("line_item_count"))
    )
    return enforce(mart, config.SPEND_MART)


def spend_by_zone_category_month(lines: DataFrame, headers: DataFrame, settings: Settings) -> DataFrame:
    """Spend, lines and mean unit cost by zone, category and month.

    An invoice seldom names a category twice, so summing before the join would shrink nothing. The lines cross the
    network once, to the join; ``headers`` should be a stored table, so that adaptive execution can split an invoice
    with very many lines.
    """
    code = c.code_in_name("site_zone", settings.zone_code_start, settings.zone_code_length)
    mart = (
        lines.select("invoice_id", "description", "line_total", "unit_cost")
        .join(headers.select("invoice_id", "site_zone", "invoice_date"), "invoice_id")
        .groupBy(
            code.alias("zone_id"),
            F.col("site_zone").alias("zone"),
            F.col("description").alias("cost_category"),
            c.month_instant("invoice_date").alias("invoice_month"),
        )
        .agg(
            total("line_total").alias("total_spend"),
            F.count(F.lit(1)).alias("line_count"),
            mean("unit_cost").alias("avg_unit_cost"),
        )
    )
    return enforce(mart, config.CATEGORY_MART)
