"""What the runs that keep gold up to date share: micro-batches from bronze or appended tables into tables in parts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluiceway.config import Settings
from sluiceway.sources.parted import PART, PartedTable, touched_parts
from sluiceway.sources.tables import remove, scratch
from sluiceway.streaming.flows import run_batches


class Steps:
    """Runs over new rows only, below ``base``. ``max_files`` bounds the files of a micro-batch; the others follow in the next.

    Every micro-batch writes under its own number, from the state before that number: one that is repeated gives the same tables.
    ``months`` is the date format that names a part of a table by month, coarser where months are small.
    """

    def __init__(self, spark: SparkSession, base: str, settings: Settings, max_files: int = 1000, months: str = "yyyy-MM"):
        self.spark, self.base, self.settings, self.max_files, self.months = spark, base, settings, max_files, months
        self._copies: list[str] = []

    def part(self, month: str) -> Column:
        """The part of a month; rows without one are a part of their own."""
        return F.coalesce(F.date_format(month, self.months), F.lit("none"))

    def table(self, name: str, schema: str | StructType) -> PartedTable:
        return PartedTable(self.spark, f"{self.base}/steps/{name}", schema)

    def bronze(self, table: str, schema: StructType) -> DataFrame:
        reader = self.spark.readStream.schema(schema).option("recursiveFileLookup", True)
        return reader.option("maxFilesPerTrigger", self.max_files).parquet(f"{self.base}/bronze/{table}")

    def appended(self, table: str, schema: str) -> DataFrame:
        """The good rows of an appended table."""
        reader = self.spark.readStream.schema(f"{schema}, _verdict string").option("maxFilesPerTrigger", self.max_files)
        good = reader.parquet(f"{self.base}/appended/{table}").where("_verdict = 'good'")
        return good.select(*StructType.fromDDL(schema).names)  # without the folders' own columns

    def kept(self, df: DataFrame) -> DataFrame:
        """A copy for the rest of a micro-batch. Micro-batches plan without adaptive execution; what reads the copy plans with it."""
        path = scratch(self.spark)
        df.write.parquet(path)
        self._copies.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def take(self, stream: DataFrame, name: str, each: Callable[[DataFrame, int], None]) -> None:
        """Hand everything that has arrived to ``each``, in micro-batches."""

        def batch(df: DataFrame, number: int) -> None:
            each(df, number)
            while self._copies:
                remove(self.spark, self._copies.pop())

        run_batches(stream, f"{self.base}/checkpoints/{name}", batch)


def add_sums(table: PartedTable, added: DataFrame, part: Column, keys: Sequence[str], sums: Sequence[str], number: int) -> list[str]:
    """Add a delivery's sums to the stored ones, reading only the parts it touches; returns those. Keys whose sums are all 0 go."""
    delta = added.withColumn(PART, part)
    touched = touched_parts(delta)
    columns = [PART, *keys, *sums]
    both = table.read(touched, before=number).withColumn(PART, part).select(*columns).unionByName(delta.select(*columns))
    kinds = {f.name: f.dataType for f in table.schema.fields}
    summed = both.groupBy(PART, *keys).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in sums])
    table.replace(summed.where(reduce(or_, [F.col(c) != 0 for c in sums])), touched, number)
    return touched
