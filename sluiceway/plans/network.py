"""Sensor readings: location-to-zone resolution, flags, two health marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway import config
from sluiceway.config import Settings
from sluiceway.functions import conforming as c
from sluiceway.functions.measures import WIDE, mean_of_parts, percent, total
from sluiceway.operators import history, resolve
from sluiceway.operators.dedup import flag_duplicates
from sluiceway.operators.quarantine import FIRST, quarantine
from sluiceway.operators.rules import FAIL, dq_metrics, fail_on_violation, flag_known, keep_valid, with_action

READING = [
    "sensor_id", "location_id", "reading_ts", "month_start_date",
    "reading_type", "reading_value", "is_duplicate", "zone_is_uncertain",
]
# Pressure and flow at one instant count as duplicates of each other: the type is not in the key.
READING_KEY = ["sensor_id", "reading_ts"]


def parsed_readings(bronze: DataFrame) -> DataFrame:
    """Timestamp and value as types; what cannot be read is NULL."""
    return bronze.withColumns(
        {"reading_ts": c.text_to_timestamp("timestamp"), "reading_value": c.number("reading_value")}
    )


def location_zone(bronze: DataFrame, settings: Settings) -> DataFrame:
    """The zone most readings of a location name."""
    counted = resolve.votes(bronze, "location_id", "zone")
    return location_zone_from_votes(counted, settings)


def location_zone_from_votes(counted: DataFrame, settings: Settings) -> DataFrame:
    """The same from stored counts, to which each batch adds its own."""
    resolved = resolve.resolve(counted, "location_id", "zone", settings.confidence_threshold)
    return fail_on_violation(resolved, with_action(config.location_rules(settings), FAIL))


def location_dq(locations: DataFrame, zones: DataFrame, settings: Settings) -> DataFrame:
    flagged = flag_known(locations, "resolved_zone", history.current(zones), "zone_name")
    return dq_metrics(flagged, config.location_rules(settings), "dim_location_zone")


def telemetry(bronze: DataFrame, locations: DataFrame, settings: Settings, row_id: str) -> DataFrame:
    """Valid readings with duplicate and uncertain-zone flags; nothing valid is dropped.

    ``row_id`` names a column that is unique per reading: exact copies, which may be many, are told apart and spread by it.

    ``locations`` should be a stored table: Spark then knows its size, broadcasts it while it is
    small, and beyond that splits a hot location in a sort-merge join.
    """
    return telemetry_of_valid(keep_valid(parsed_readings(bronze), config.READING_HARD), locations, settings, row_id)


def telemetry_of_valid(valid: DataFrame, locations: DataFrame, settings: Settings, row_id: str) -> DataFrame:
    """The same for readings that are parsed and judged already."""
    valid = valid.withColumn("month_start_date", c.month_start("reading_ts"))
    tie_break = ["reading_value", "reading_type", "location_id", "zone", row_id]
    narrow = valid.select(*READING_KEY, "month_start_date", *tie_break)
    flagged = flag_duplicates(narrow, READING_KEY, tie_break, tie_break, settings.lanes)
    joined = flagged.join(locations, "location_id", "left")
    return joined.withColumn("zone_is_uncertain", resolve.zone_uncertain()).select(*READING)


def with_zone_doubt(flagged: DataFrame, locations: DataFrame) -> DataFrame:
    """Readings whose duplicates are flagged already, as published: month and uncertain-zone flag added."""
    joined = flagged.withColumn("month_start_date", c.month_start("reading_ts")).join(locations, "location_id", "left")
    return joined.withColumn("zone_is_uncertain", resolve.zone_uncertain()).select(*READING)


def telemetry_quarantine(bronze: DataFrame, settings: Settings, source: str = "bronze.sensor_readings") -> DataFrame:
    return quarantine(parsed_readings(bronze), config.READING_HARD, settings.processed_at, FIRST, source)


def telemetry_dq(readings: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return dq_metrics(readings, config.READING_SOFT, "network_telemetry", by)


#: Sums and counts that later readings add to; see ``reading_parts``.
PARTS = (
    "location_id string, month_start_date date, zone string, pressure_sum decimal(38,6), pressure_count bigint, "
    "flow_sum decimal(38,6), flow_count bigint, all_count bigint, fresh_count bigint"
)
PART_KEY = ["location_id", "month_start_date", "zone"]
PART_SUMS = ["pressure_sum", "pressure_count", "flow_sum", "flow_count", "all_count", "fresh_count"]


def reading_parts(rows: DataFrame) -> DataFrame:
    """What readings add per location, month and zone they name.

    ``counted`` is 1 for a reading that is new, 0 for one that was counted before; ``fresh`` is 1 for a first reading, 0 for a
    duplicate, and -1 for one that has become a duplicate, whose value is taken off again.
    """

    def sums(kind: str) -> list:
        value = F.when(F.col("reading_type") == kind, F.col("reading_value").cast(WIDE))
        signed = F.when(F.col("fresh") > 0, value).when(F.col("fresh") < 0, -value)
        counted = F.when(value.isNotNull(), F.col("fresh")).otherwise(0)
        return [F.coalesce(F.sum(signed), F.lit(0)).cast("decimal(38,6)").alias(f"{kind}_sum"), F.sum(counted).alias(f"{kind}_count")]

    everything = [F.sum("counted").alias("all_count"), F.sum("fresh").alias("fresh_count")]
    return rows.groupBy(*PART_KEY).agg(*sums("pressure"), *sums("flow"), *everything)


def per_location_of_parts(parts: DataFrame, locations: DataFrame) -> DataFrame:
    """The same as over readings: which of them are uncertain follows from the zone they name and the location's zone now."""
    joined = parts.join(locations.where("resolved_zone IS NOT NULL"), "location_id")
    doubt = resolve.zone_uncertain()
    return joined.select(
        *[c for c in parts.columns if c not in PART_KEY], "month_start_date", "is_ambiguous",
        F.when(doubt, 0).otherwise(F.col("fresh_count")).alias("reliable_count"),
        F.when(doubt, F.col("all_count")).otherwise(0).alias("uncertain_count"),
        F.col("resolved_zone").alias("zone"),
    )


def _per_location(readings: DataFrame, locations: DataFrame) -> DataFrame:
    """Partial sums and counts per location and month, with the location's zone.

    Summing before the join makes the joined side as small as locations times months. Only
    locations that resolve to a zone take part.
    """
    fresh = ~F.col("is_duplicate")

    def parts(kind: str) -> list:
        value = F.when(fresh & (F.col("reading_type") == kind), F.col("reading_value"))
        return [total(value).alias(f"{kind}_sum"), F.count(value).alias(f"{kind}_count")]

    partial = readings.groupBy("location_id", "month_start_date").agg(
        *parts("pressure"),
        *parts("flow"),
        F.count(F.lit(1)).alias("all_count"),
        F.count_if(fresh).alias("fresh_count"),
        F.count_if(fresh & ~F.col("zone_is_uncertain")).alias("reliable_count"),
        F.count_if(F.col("zone_is_uncertain")).alias("uncertain_count"),
    )
    resolved = locations.where("resolved_zone IS NOT NULL")
    return partial.join(resolved, "location_id").withColumnRenamed("resolved_zone", "zone")


def network_health(readings: DataFrame, locations: DataFrame) -> DataFrame:
    """Mean pressure and flow from trusted locations, duplicates left out.

    Trust is that of the location: a reading that names another zone still counts.
    """
    return health_of_parts(_per_location(readings, locations.where("NOT is_ambiguous")))


def health_of_parts(parts: DataFrame) -> DataFrame:
    mart = (
        parts.where("fresh_count > 0")
        .groupBy("zone", "month_start_date")
        .agg(
            mean_of_parts("pressure_sum", "pressure_count").alias("avg_pressure"),
            mean_of_parts("flow_sum", "flow_count").alias("avg_flow"),
            F.sum("fresh_count").alias("reading_count"),
        )
    )
    return fail_on_violation(mart, config.NETWORK_MART)


def network_diagnostic(readings: DataFrame, locations: DataFrame) -> DataFrame:
    """All readings of resolved locations, with how many of them can be relied on."""
    return diagnostic_of_parts(_per_location(readings, locations))


def diagnostic_of_parts(parts: DataFrame) -> DataFrame:
    mart = (
        parts.groupBy("zone", "month_start_date")
        .agg(
            mean_of_parts("pressure_sum", "pressure_count").alias("avg_pressure"),
            mean_of_parts("flow_sum", "flow_count").alias("avg_flow"),
            F.sum("all_count").alias("total_readings"),
            F.sum("reliable_count").alias("reliable_readings"),
            F.sum(F.col("all_count") - F.col("fresh_count")).alias("duplicate_count"),
            F.sum("uncertain_count").alias("zone_uncertain_count"),
        )
        .withColumn("reliability_pct", percent("reliable_readings", "total_readings"))
    )
    columns = [
        "zone", "month_start_date", "avg_pressure", "avg_flow", "total_readings",
        "reliable_readings", "reliability_pct", "duplicate_count", "zone_uncertain_count",
    ]
    return fail_on_violation(mart, with_action(config.NETWORK_DIAGNOSTIC_MART, FAIL)).select(*columns)
