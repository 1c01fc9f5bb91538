"""The registry, the settings for the driver's tables, and inputs that several queries share."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sluiceway.config import Settings
from sluiceway.plans import billing, contractors, finance, network
from sluiceway.plans.scorecard import Marts
from sluiceway.queries.oracle import with_inputs
from sluiceway.sources.driver_tables import DriverTables
from sluiceway.sources.tables import store, store_all

SETTINGS = Settings(
    as_of=dt.date(2001, 6, 30),
    processed_at=dt.datetime(2001, 6, 30, 6, 0, 0),
    lanes=16,
    earliest_date=dt.date(1996, 1, 1),
    cost_cap=100_000,
    confidence_threshold=80.0,
    zone_code_start=8,
    zone_code_length=2,
)


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    covers: str


QUERIES: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Register a function of (inputs) under its name; ``sql`` may name the shared inputs of ``oracle``."""

    def register(function: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, directory: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(Inputs(spark, directory))

        QUERIES[function.__name__] = Query(run, with_inputs(sql) if sql else None, covers)
        return function

    return register


class Inputs(DriverTables):
    """Landing inputs plus the silver and gold datasets built from them."""

    def consumption(self) -> DataFrame:
        return billing.billing_consumption(self.bills())

    def headers(self) -> DataFrame:
        return finance.invoices(self.invoice_headers(), SETTINGS)

    def stored_headers(self) -> DataFrame:
        """For joins with single lines: a stored side lets adaptive execution split a hot invoice."""
        return store(self.headers())

    def lines(self) -> DataFrame:
        return finance.line_items(self.invoice_line_records())

    def orders(self) -> DataFrame:
        return contractors.works_orders(self.works_orders(), self.zones(), SETTINGS)

    def locations(self) -> DataFrame:
        """Stored, so that its size is known when facts are joined to it."""
        return store(network.location_zone(self.readings(), SETTINGS))

    def telemetry(self, locations: DataFrame) -> DataFrame:
        return network.telemetry(self.readings(), locations, SETTINGS, "seq")

    def billing_mart(self) -> DataFrame:
        return billing.billing_by_zone_month(self.consumption())

    def spend_mart(self) -> DataFrame:
        return finance.spend_by_zone_month(self.lines(), self.headers())

    def contractor_mart(self) -> DataFrame:
        return contractors.contractor_by_zone_month(self.orders())

    def marts(self) -> Marts:
        """The four marts, stored: the scorecard reads each of them twice."""
        locations = self.locations()
        return Marts(
            **store_all(
                {
                    "billing": self.billing_mart(),
                    "spend": self.spend_mart(),
                    "contractor": self.contractor_mart(),
                    "network": network.network_diagnostic(self.telemetry(locations), locations),
                }
            )
        )
