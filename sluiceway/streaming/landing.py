"""Bronze: the six landing folders into tables, each run picking up the files that are new."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from sluiceway import config
from sluiceway.operators import widen
from sluiceway.operators.conform import union_all
from sluiceway.operators.rules import Rule
from sluiceway.plans.refresh import Bronze
from sluiceway.sources import files, schemas, versions
from sluiceway.sources.tables import few_rows
from sluiceway.streaming.flows import BATCH, METRICS, append_counted, batch_table

# One folder per source, as the senders name them.
FOLDERS = {
    "billing_customer": "billing_customer",
    "finance_invoices_raw": "finance_erp",
    "works_orders_a": "contractor_a",
    "works_orders_b": "contractor_b",
    "works_orders_c": "contractor_c",
    "sensor_readings": "network_telemetry",
}
DECLARED = {
    "billing_customer": schemas.BILLS,
    "finance_invoices_raw": schemas.INVOICE,
    **{f"works_orders_{letter}": schemas.WORKS_ORDERS[f"contractor_{letter}"] for letter in "abc"},
    "sensor_readings": schemas.READINGS,
}


class Landing:
    """Lands files below one folder into tables below another.

    ``max_files`` bounds the files of a micro-batch, so that a first run over a long backlog goes in steps; nothing is left out.
    Landing keeps every row: the rules only count. Each micro-batch's counts are kept beside the tables, in ``ops/landing_counts``.
    """

    def __init__(self, spark: SparkSession, landing: str, base: str, max_files: int):
        self.spark, self.landing, self.base, self.max_files = spark, landing, base, max_files
        self.ran: dict[str, list[int]] = {}

    def _folder(self, table: str) -> str:
        return f"{self.landing}/{FOLDERS[table]}"

    def _land(self, table: str, stream: DataFrame, rule_set: Sequence[Rule], read: Callable | None = None, table_at: Callable = batch_table) -> DataFrame:
        path = f"{self.base}/bronze/{table}"
        self.ran[table] = append_counted(
            stream, path, f"{self.base}/checkpoints/{table}", rule_set, f"bronze.{table}", f"{self.base}/ops/landing_counts/{table}", read
        )
        return table_at(self.spark, path)

    def csv(self, table: str, declared: StructType, rule_set: Sequence[Rule]) -> DataFrame:
        """Columns by the names in each file's header; added columns are carried on."""

        def read(batch: DataFrame) -> DataFrame:
            paths = [row["path"] for row in batch.select("path").collect()]  # at most max_files
            return files.csv_by_name(batch.sparkSession, paths, declared)

        return self._land(table, files.file_names(self.spark, self._folder(table), self.max_files), rule_set, read)

    def widened_csv(self, table: str, hints: StructType, rule_set: Sequence[Rule]) -> DataFrame:
        """As ``csv``, but columns without a hint take the type of their values and are widened when a delivery needs it.

        Every value stays, in the newest type; ``versions.read_widened`` and ``version_log`` tell how the table stood before.
        """
        texts = StructType([StructField(name, schemas.TEXT) for name in hints.names])

        def read(batch: DataFrame) -> DataFrame:
            spark = batch.sparkSession
            paths = [row["path"] for row in batch.select("path").collect()]  # at most max_files
            return widen.typed(files.csv_by_name(spark, paths, texts), hints, versions.newest(spark, f"{self.base}/bronze/{table}"))

        stream = files.file_names(self.spark, self._folder(table), self.max_files)
        return self._land(table, stream, rule_set, read, versions.read_widened)

    def bills(self) -> DataFrame:
        return self.csv("billing_customer", schemas.BILLS, config.BILL_LANDING)

    def works_orders(self) -> dict[str, DataFrame]:
        names = {f"contractor_{letter}": f"works_orders_{letter}" for letter in "abc"}
        return {name: self.csv(table, schemas.WORKS_ORDERS[name], config.WORKS_LANDING[name]) for name, table in names.items()}

    def invoices(self) -> DataFrame:
        pages = files.invoice_pages(self.spark, self._folder("finance_invoices_raw"), stream=True, max_files=self.max_files)
        return self._land("finance_invoices_raw", pages, config.INVOICE_LANDING)

    def readings(self) -> DataFrame:
        """Readings get a row id, so that exact copies can later be told apart."""
        lines = files.json_lines(self.spark, self._folder("sensor_readings"), schemas.READINGS, stream=True, max_files=self.max_files)
        return self._land("sensor_readings", files.with_row_id(lines), config.READING_LANDING)

    def all(self) -> dict:
        """All sources side by side: the many short micro-batches of one do not keep the others waiting."""
        runs = {"bills": self.bills, "invoices": self.invoices, "works_orders": self.works_orders, "readings": self.readings}
        with ThreadPoolExecutor(len(runs)) as pool:
            jobs = {name: pool.submit(land) for name, land in runs.items()}
            return {name: job.result() for name, job in jobs.items()}

    def rule_counts(self, this_run: bool = False) -> DataFrame:
        """What the rules counted in every micro-batch, of all runs or of this one: dataset, rule, action, passed, failed, batch number."""
        schema = f"{METRICS}, {BATCH} int"
        found = [few_rows(self.spark, [], schema)]
        for table, ran in self.ran.items():
            if ran or not this_run:
                at = f"{self.base}/ops/landing_counts/{table}"
                counts = self.spark.read.schema(schema).option("pathGlobFilter", "*.json").json(at)
                counts = counts.unionByName(self.spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(at))  # of runs before they were JSON
                found.append(counts.where(F.col(BATCH) >= min(ran)) if this_run else counts)
        return union_all(found)

    def drift(self) -> DataFrame:
        """Columns that deliveries have brought beyond the declared ones, or lack: table, column, change."""
        found = []
        for table, declared in DECLARED.items():
            actual = batch_table(self.spark, f"{self.base}/bronze/{table}").drop(schemas.RESCUE, files.SOURCE_FILE, "_row_id").schema
            found.append(files.drift(self.spark, declared, actual).withColumn("table_name", F.lit(f"bronze.{table}")))
        return union_all(found)


def land_all(spark: SparkSession, landing: str, base: str, zones: DataFrame, max_files: int = 1000) -> tuple[Bronze, DataFrame]:
    """Append new files of every source to its bronze table below ``base``.

    Returns the tables, and the rule counts of this run, summed over its micro-batches. The counts of all runs are
    ``Landing.rule_counts``.
    """
    run = Landing(spark, landing, base, max_files)
    bronze = Bronze(**run.all(), zones=zones, row_id="_row_id")
    counts = run.rule_counts(this_run=True)
    return bronze, counts.groupBy("dataset", "rule", "action").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))
