"""The zone master: founding rows, merges, versions, changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway import config
from sluiceway.sources.schemas import ZONE_MASTER
from sluiceway.sources.tables import create_schema, create_table, seed_if_empty

SCHEMA_COMMENT = "Shared reference data, written by the data owners only"
TABLE_COMMENT = "Zone master"


def founding_zones(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(config.ZONE_SEED, ZONE_MASTER)


def set_up(spark: SparkSession, schema: str, location: str, seed: DataFrame) -> DataFrame:
    """Create schema and table if absent, seed an empty table, and return the table."""
    create_schema(spark, schema, location, SCHEMA_COMMENT)
    create_table(spark, f"{schema}.dim_zone", ZONE_MASTER, TABLE_COMMENT)
    seed_if_empty(spark, f"{schema}.dim_zone", seed.select(*ZONE_MASTER.names))
    return spark.read.table(f"{schema}.dim_zone")


def zones_named_by(facts: DataFrame, zone: str, since: str) -> DataFrame:
    """A candidate master row for every zone name that facts use, in force since its first use."""
    first_use = facts.where(F.col(zone).isNotNull()).groupBy(F.col(zone).alias("zone_name")).agg(F.min(since).alias("since"))
    missing = {"district": "string", "region": "string", "population_served": "int", "district_manager": "string"}
    return first_use.select(
        F.col("zone_name").alias("zone_id"),
        "zone_name",
        *[F.lit(None).cast(kind).alias(name) for name, kind in missing.items()],
        F.lit(None).cast("int").alias("sla_response_hours"),
        F.col("since").alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current"),
    )
