"""Time the headline queries on the driver's tables and print one JSON line.

Every query is computed in full into Spark's no-op sink; nothing comes back to the driver. Each one
runs twice: ``first_run`` includes Spark's code generation, ``queries`` is the second run.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from sluiceway.plans.scorecard import zone_performance
from sluiceway.queries import QUERIES
from sluiceway.queries.registry import SETTINGS, Inputs
from sluiceway.sources.tables import clear_scratch, store

HEADLINES = [
    "billing_consumption",
    "billing_by_zone_month",
    "billing_quarantine",
    "billing_dq_metrics",
    "pii_scd2",
    "invoices",
    "line_items",
    "spend_by_zone_month",
    "spend_by_zone_category_month",
    "works_orders",
    "works_orders_quarantine",
    "contractor_by_zone_month",
    "works_by_zone_type_month",
    "location_zone",
    "telemetry",
    "network_health",
    "network_diagnostic",
    "zone_performance",
    "spend_share",
    "stream_multi_flow",
]


def scorecard_on_stored_marts(spark: SparkSession, directory: str) -> float:
    """The scorecard alone: its four marts are written before the clock starts."""
    inputs = Inputs(spark, directory)
    zones, marts = store(inputs.zones()), inputs.marts()
    started = time.perf_counter()
    zone_performance(zones, marts, SETTINGS).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name].run(spark, directory).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - started, 3)

    first, seconds = {}, {}
    for name in HEADLINES:
        first[name] = timed(name)
        seconds[name] = timed(name)
    on_stored = scorecard_on_stored_marts(spark, directory)
    clear_scratch(spark)
    spark.stop()
    result = {
        "metric": "total seconds over headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "first_run": first,
        "zone_performance_on_stored_marts": on_stored,
        "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
