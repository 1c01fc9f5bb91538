"""Silver in steps: each run takes the bronze files that are new and appends good rows and quarantines.

Run it after a landing run has ended: a micro-batch of bronze that is repeated after a crash replaces its files. Appended tables have a
folder of their own, ``appended``: the daily run rebuilds those in ``silver`` and ``gold``, and neither touches the other's.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from sluiceway import config
from sluiceway.config import Settings
from sluiceway.operators.quarantine import bad_rows, good_rows, with_verdict
from sluiceway.plans import contractors, finance
from sluiceway.sources import schemas
from sluiceway.sources.files import SOURCE_FILE
from sluiceway.sources.tables import exists
from sluiceway.streaming.flows import once_per_key, split_stream
from sluiceway.streaming.once import OnceRun


class Silver:
    """Appended tables below ``base``, fed from the bronze tables below it.

    ``max_files`` bounds the bronze files of a micro-batch; the others follow in the next.
    """

    def __init__(self, spark: SparkSession, base: str, settings: Settings, max_files: int = 1000):
        self.spark, self.base, self.settings, self.max_files = spark, base, settings, max_files

    def _bronze(self, table: str, schema: StructType) -> DataFrame:
        reader = self.spark.readStream.schema(schema).option("recursiveFileLookup", True)
        return reader.option("maxFilesPerTrigger", self.max_files).parquet(f"{self.base}/bronze/{table}")

    def _split(self, name: str, stream: DataFrame, rule_set) -> tuple[DataFrame, DataFrame]:
        path, checkpoint = f"{self.base}/appended/{name}", f"{self.base}/checkpoints/silver_{name}"
        routed = split_stream(stream, rule_set, self.settings, path, checkpoint)
        return good_rows(routed), bad_rows(routed)

    def _invoice_records(self) -> DataFrame:
        return self._bronze("finance_invoices_raw", StructType([*schemas.INVOICE.fields, StructField(SOURCE_FILE, schemas.TEXT)]))

    def invoices(self) -> tuple[DataFrame, DataFrame]:
        """Headers, one per invoice for ever; copies of a hot invoice are thinned out in each map task.

        The invoices let through are kept in files, not in a stream's state, which would hold all of them in the executors' memory. A table
        begun with such a state goes on with it.
        """
        rule_set = [r for r in config.invoice_rules(self.settings) if r.action == "drop"]
        if exists(self.spark, f"{self.base}/appended/finance_invoices/_spark_metadata"):
            once = once_per_key(self._invoice_records(), "invoice_id", [SOURCE_FILE], self.settings.lanes)
            return self._split("finance_invoices", finance.flatten_headers(once), rule_set)
        run = OnceRun(
            self.spark, self.base, self.settings, "finance_invoices", "invoice_id", finance.HEADER, self.max_files,
            route=lambda rows: with_verdict(rows, rule_set, self.settings.processed_at), partition_by=["_verdict"],
        )
        routed = run.run(finance.flatten_headers(self._invoice_records()))
        return good_rows(routed), bad_rows(routed)

    def lines(self) -> tuple[DataFrame, DataFrame]:
        return self._split("invoice_line_items", finance.incoming_lines(self._invoice_records()), config.LINE_HARD)

    def works_orders(self, zones: DataFrame) -> tuple[DataFrame, DataFrame]:
        sources: Mapping[str, DataFrame] = {
            f"contractor_{letter}": self._bronze(f"works_orders_{letter}", schemas.WORKS_ORDERS[f"contractor_{letter}"]) for letter in "abc"
        }
        stream = contractors.with_zone_id(contractors.conformed_orders(sources), zones, self.settings)
        return self._split("works_orders", stream, config.works_rules(self.settings))
