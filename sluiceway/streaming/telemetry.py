"""The short run of the sensors: new readings only, from bronze to the two health marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from sluiceway import config
from sluiceway.config import Settings
from sluiceway.operators import resolve
from sluiceway.operators.quarantine import FIRST, first_reason, quarantine
from sluiceway.operators.rules import all_pass
from sluiceway.plans import network
from sluiceway.sources import schemas
from sluiceway.sources.parted import PART, bucket, touched_parts
from sluiceway.streaming.flows import BATCH
from sluiceway.streaming.steps import Steps, add_sums

_BEST = "struct<reading_value: double, reading_type: string, location_id: string, zone: string, _row_id: string>"
_WINNER = f"sensor_id string, reading_ts timestamp, best {_BEST}"
_ROUTED = "sensor_id string, location_id string, timestamp string, zone string, reading_type string, reading_value double, _row_id string, " \
    "reading_ts timestamp, quarantine_reason string, is_duplicate boolean"
_DIAGNOSTIC = "zone string, month_start_date date, avg_pressure double, avg_flow double, total_readings bigint, reliable_readings bigint, " \
    "reliability_pct double, duplicate_count bigint, zone_uncertain_count bigint"
_HEALTH = "zone string, month_start_date date, avg_pressure double, avg_flow double, reading_count bigint"


class TelemetryRun(Steps):
    """New readings are routed by verdict in one write, with their duplicates flagged; their votes and sums join those so far.

    No run reads earlier readings. The first reading of each sensor and instant is kept in ``winners``, in parts by day and a hash of the
    key, of which a run reads and rewrites those that its readings fall into. A reading that comes late and goes before the
    first one so far takes its place; that one is listed in ``demoted``. Marts follow by month: those of new readings, and those of
    locations whose resolved zone has changed.

    ``days`` is the date format that names a part, ``buckets`` the parts of a day and of the votes: a part should be what a few tasks can merge.
    """

    def __init__(
        self, spark: SparkSession, base: str, settings: Settings, max_files: int = 1000, months: str = "yyyy-MM", days: str = "yyyy-MM-dd", buckets: int = 16
    ):
        super().__init__(spark, base, settings, max_files, months)
        self.days, self.buckets = days, buckets
        self.routed = f"{base}/appended/readings_routed"
        self.demoted = f"{base}/appended/readings_demoted"
        self.winners = self.table("reading_winners", _WINNER)
        self.counts = self.table("zone_votes", "location_id string, zone string, votes bigint")
        self.parts = self.table("reading_parts", network.PARTS)
        self.diagnostic = self.table("network_health_diagnostic_by_zone_month", _DIAGNOSTIC)
        self.health = self.table("network_health_by_zone_month", _HEALTH)

    def _winners(self, good: DataFrame, number: int) -> DataFrame:
        """Merge a batch into the winners. Returns the keys it names: the first reading now, and the one held before."""
        best = F.struct("reading_value", "reading_type", "location_id", "zone", "_row_id")
        part = F.concat(F.date_format("reading_ts", self.days), F.lit("."), bucket(network.READING_KEY, self.buckets))
        arrived = self.kept(good.groupBy(*network.READING_KEY).agg(F.min(best).alias("best")).withColumn(PART, part))
        touched = touched_parts(arrived)
        before = self.winners.read(touched, before=number).withColumn(PART, part).withColumn("held", F.col("best"))
        both = before.unionByName(arrived.withColumn("held", F.lit(None).cast(_BEST)))
        merged = both.groupBy(PART, *network.READING_KEY).agg(F.min("best").alias("best"), F.max("held").alias("held"))
        merged = self.kept(merged)
        self.winners.replace(merged, touched, number)
        return merged.where(~F.col("best").eqNullSafe(F.col("held")))

    def _take(self, batch: DataFrame, number: int) -> None:
        parsed = network.parsed_readings(batch)
        good = all_pass(config.READING_HARD)
        changed = self._winners(parsed.where(good), number)
        won = changed.select(F.col("best._row_id").alias("_won"))
        lost = changed.where("held IS NOT NULL").select("sensor_id", "reading_ts", "held.*")
        lost.write.mode("overwrite").parquet(f"{self.demoted}/{BATCH}={number}")
        flagged = parsed.join(won, F.col("_row_id") == F.col("_won"), "left").withColumns(
            {
                "quarantine_reason": first_reason(config.READING_HARD),
                "is_duplicate": F.when(good, F.col("_won").isNull()),
                "_verdict": F.when(good, F.lit("good")).otherwise(F.lit("bad")),
            }
        )
        path = f"{self.routed}/{BATCH}={number}"
        columns = [*StructType.fromDDL(_ROUTED).names, "_verdict"]
        flagged.select(*columns).write.mode("overwrite").partitionBy("_verdict").parquet(path)
        arrived = self.spark.read.schema(f"{_ROUTED}, _verdict string").parquet(path)
        moved = self._vote(arrived, number)
        new = arrived.where("_verdict = 'good'").select(
            "location_id", "reading_ts", "zone", "reading_type", "reading_value", F.lit(1).alias("counted"), F.expr("if(is_duplicate, 0, 1) AS fresh")
        )
        gone = self.spark.read.schema(lost.schema).parquet(f"{self.demoted}/{BATCH}={number}")
        off = gone.select("location_id", "reading_ts", "zone", "reading_type", "reading_value", F.lit(0).alias("counted"), F.lit(-1).alias("fresh"))
        month = F.trunc("reading_ts", "MM").alias("month_start_date")
        added = network.reading_parts(new.unionByName(off).select("*", month))
        months = add_sums(self.parts, self.kept(added), self.part("month_start_date"), network.PART_KEY, network.PART_SUMS, number)
        self._publish(sorted({*months, *self._months_of(moved)}), number)

    def _vote(self, arrived: DataFrame, number: int) -> DataFrame:
        """Add the batch's votes; returns the locations whose resolved zone or its trust has changed."""
        part = bucket(["location_id"], self.buckets)
        votes = self.kept(resolve.votes(arrived.select("location_id", "zone"), "location_id", "zone"))
        touched = add_sums(self.counts, votes, part, ["location_id", "zone"], ["votes"], number)
        threshold = self.settings.confidence_threshold
        before, after = (
            resolve.resolve(self.counts.read(touched, before=n), "location_id", "zone", threshold).select(
                F.col("location_id").alias(f"{side}_id"), F.struct("resolved_zone", "is_ambiguous").alias(side)
            )
            for side, n in (("old", number), ("new", None))
        )
        both = after.join(before, F.col("new_id") == F.col("old_id"), "left")
        return both.where(F.col("old_id").isNotNull() & ~F.col("old").eqNullSafe(F.col("new"))).select(F.col("new_id").alias("moved_id"))

    def _months_of(self, moved: DataFrame) -> list[str]:
        """The months in which these locations have readings, from the sums."""
        held = self.parts.read().select("location_id", self.part("month_start_date").alias(PART))
        return touched_parts(held.join(self.kept(moved), F.col("location_id") == F.col("moved_id"), "left_semi"))

    def _publish(self, months: list[str], number: int) -> None:
        """Both marts for these months, from the sums."""
        known = network.per_location_of_parts(self.parts.read(months), self.kept(self.locations()))
        for table, mart in (
            (self.diagnostic, network.diagnostic_of_parts(known)),
            (self.health, network.health_of_parts(known.where("NOT is_ambiguous"))),
        ):
            table.replace(mart.withColumn(PART, self.part("month_start_date")), months, number)

    def run(self) -> None:
        """Take everything that has arrived."""
        schema = StructType([*schemas.READINGS.fields, StructField("_row_id", schemas.TEXT)])
        self.take(self.bronze("sensor_readings", schema), "telemetry", self._take)

    def votes(self) -> DataFrame:
        """The counts of all votes up to the newest batch that ended."""
        return self.counts.read()

    def locations(self) -> DataFrame:
        return network.location_zone_from_votes(self.votes(), self.settings)

    def _readings(self, verdict: str) -> DataFrame:
        routed = self.spark.read.schema(f"{_ROUTED}, {BATCH} int, _verdict string").parquet(self.routed)
        return routed.where(F.col("_verdict") == verdict).drop("_verdict", BATCH)

    def readings(self, locations: DataFrame) -> DataFrame:
        """All good readings with both flags: those flagged on arrival, and those that a later one has taken the place of."""
        lost = self.spark.read.schema("_row_id string").parquet(self.demoted).select(F.col("_row_id").alias("_lost")).distinct()
        good = self._readings("good").join(lost, F.col("_row_id") == F.col("_lost"), "left")
        return network.with_zone_doubt(good.withColumn("is_duplicate", F.col("is_duplicate") | F.col("_lost").isNotNull()), locations)

    def rejected(self) -> DataFrame:
        bad = self._readings("bad").drop("quarantine_reason", "is_duplicate", "_row_id")
        return quarantine(bad, config.READING_HARD, self.settings.processed_at, FIRST, "bronze.sensor_readings")
