"""Contractor works orders: three layouts into one table, two marts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway import config
from sluiceway.config import Settings
from sluiceway.functions import conforming as c
from sluiceway.functions.measures import mean, total
from sluiceway.operators import history
from sluiceway.operators.conform import conform_sources
from sluiceway.operators.lookup import fits, lookup
from sluiceway.operators.quarantine import quarantine
from sluiceway.operators.rules import enforce, keep_valid_parsed

ORDER = ["work_order_id", "zone", "description", "contractor_source", "completion_date", "cost"]


def registry() -> dict[str, dict[str, Column]]:
    """Per contractor, the expression behind each shared column. To add one, add its headers to the settings."""
    return {
        name: {
            "work_order_id": F.col(headers["work_order_id"]).cast("string"),
            "zone": F.col(headers["zone"]),
            "description": F.col(headers["description"]),
            "completion_date": c.text_to_date(headers["completion_date"]),
            "cost": c.charge_amount(headers["cost"]) if headers["cost"] == "charge" else c.number(headers["cost"]),
        }
        for name, headers in config.CONTRACTORS.items()
    }


def conformed_orders(sources: Mapping[str, DataFrame]) -> DataFrame:
    return conform_sources(sources, registry(), "contractor_source").select(*ORDER)


def with_zone_id(orders: DataFrame, zones: DataFrame, settings: Settings) -> DataFrame:
    """Add the id of the current zone of that name; NULL if there is none.

    On a stream the zones are measured first: up to the setting's number of bytes they are broadcast, beyond it the
    orders of a hot zone are salted and the zones repeated for each lane.
    """
    names = history.current(zones).select("zone_id", F.col("zone_name").alias("_zone_name"))
    if not orders.isStreaming:
        return lookup(orders, names, "zone", "_zone_name")
    if fits(names, settings.dimension_bytes):
        return lookup(orders, F.broadcast(names), "zone", "_zone_name")
    return lookup(orders, names, "zone", "_zone_name", spread=ORDER, salts=settings.lanes)


def works_orders(sources: Mapping[str, DataFrame], zones: DataFrame, settings: Settings) -> DataFrame:
    """Valid orders. The rule on the zone is also a plain filter, which turns the left join into an inner one."""
    enriched = with_zone_id(conformed_orders(sources), zones, settings).where("zone_id IS NOT NULL")
    return keep_valid_parsed(enriched, config.works_rules(settings))


def works_orders_quarantine(sources: Mapping[str, DataFrame], zones: DataFrame, settings: Settings) -> DataFrame:
    enriched = with_zone_id(conformed_orders(sources), zones, settings)
    return quarantine(enriched, config.works_rules(settings), settings.processed_at)


def contractor_by_zone_month(orders: DataFrame) -> DataFrame:
    mart = orders.groupBy("zone", "contractor_source", c.month_instant("completion_date").alias("completion_month")).agg(
        F.count(F.lit(1)).alias("work_order_count"), total("cost").alias("total_cost")
    )
    return enforce(mart, config.CONTRACTOR_MART)


def works_by_zone_type_month(orders: DataFrame) -> DataFrame:
    month = c.month_instant("completion_date").alias("completion_month")
    mart = (
        orders.groupBy("zone_id", "zone", F.col("description").alias("work_type"), month)
        .agg(
            F.count(F.lit(1)).alias("order_count"), total("cost").alias("total_cost"), mean("cost").alias("avg_cost")
        )
    )
    return enforce(mart, config.WORK_TYPE_MART)
