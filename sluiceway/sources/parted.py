"""Tables in named parts, of which a run replaces those that its new rows touch and reads no others.

A replacement writes the touched parts into a folder of its own number; a small table, written last, says which number holds
each part, and makes the replacement valid. So a run that was stopped leaves the table as it was, and one that is repeated under
its number starts from what stood before it. The newest two states are kept; files that neither names are deleted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sluiceway.sources.tables import children, few_rows, no_rows, remove

PART = "_part"
_HOLDS = f"{PART} string, number bigint"


def bucket(keys: Sequence[str], buckets: int) -> Column:
    """One of so many parts, by a hash of the keys."""
    return F.format_string("b%05d", F.pmod(F.xxhash64(*keys), F.lit(buckets)))


class PartedTable:
    """A table below ``path``. Rows to store hold the part's name in ``_part``, of letters, digits, ``.`` and ``-``.

    The names of all parts come to the driver: a table has as many as its caller's buckets or calendar gives, not as many as its rows.
    One writer at a time; numbers grow from run to run, as those of a stream's micro-batches do.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str | StructType):
        self.spark, self.path = spark, path
        self.schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)

    def _numbers(self) -> list[int]:
        """The replacements that are valid, oldest first."""
        found = [int(name.partition("=")[2]) for name in children(self.spark, f"{self.path}/holds") if name.startswith("n=")]
        return sorted(n for n in found if "_SUCCESS" in children(self.spark, f"{self.path}/holds/n={n}"))

    def _holds(self, number: int | None) -> dict[str, int]:
        if number is None:
            return {}
        rows = self.spark.read.schema(_HOLDS).parquet(f"{self.path}/holds/n={number}").collect()
        return {row[PART]: row["number"] for row in rows}

    def newest(self, before: int | None = None) -> int | None:
        """The number of the state that stands, or stood before a given number."""
        return max((n for n in self._numbers() if before is None or n < before), default=None)

    def parts(self, before: int | None = None) -> Mapping[str, int]:
        """Which number holds each part."""
        return self._holds(self.newest(before))

    def files(self, parts: Sequence[str] | None = None, before: int | None = None) -> list[str]:
        """The folders of some parts, or of all."""
        held = self.parts(before)
        return [f"{self.path}/data/n={held[p]}/{PART}={p}" for p in (held if parts is None else parts) if p in held]

    def read(self, parts: Sequence[str] | None = None, before: int | None = None, named: bool = False) -> DataFrame:
        """The rows of some parts, or of all; no file of another part is listed or read. ``named`` adds the part's name, ``_part``."""
        folders = self.files(parts, before)
        schema = StructType([*self.schema.fields, StructField(PART, StringType())]) if named else self.schema
        if not folders:
            return no_rows(self.spark, schema)
        reader = self.spark.read.schema(schema)
        if named:
            reader = reader.option("basePath", f"{self.path}/data")
        return reader.parquet(*folders).select(*schema.names)

    def replace(self, rows: DataFrame, touched: Sequence[str], number: int) -> None:
        """Put ``rows`` in the place of the ``touched`` parts; a touched part without rows is gone. ``rows`` may read the state before.

        Nothing changes if no part is touched.
        """
        if not touched:
            return
        before = self.newest(before=number)
        folder = f"{self.path}/data/n={number}"
        # Gathered by part, so that a part is few files; adaptive execution splits a part that is large.
        gathered = rows.select(PART, *self.schema.names).hint("rebalance", F.col(PART))
        gathered.write.mode("overwrite").partitionBy(PART).parquet(folder)
        written = {name.partition("=")[2]: number for name in children(self.spark, folder) if name.startswith(f"{PART}=")}
        held = {p: n for p, n in self._holds(before).items() if p not in set(touched)} | written
        state = few_rows(self.spark, sorted(held.items()), _HOLDS)
        state.write.mode("overwrite").parquet(f"{self.path}/holds/n={number}")
        self._forget(before)

    def _forget(self, kept: int | None) -> None:
        """Delete what only states older than ``kept`` name."""
        if kept is None:
            return
        needed = set(self._holds(kept).items())
        for old in [n for n in self._numbers() if n < kept]:
            for part, number in set(self._holds(old).items()) - needed:
                remove(self.spark, f"{self.path}/data/n={number}/{PART}={part}")
            remove(self.spark, f"{self.path}/holds/n={old}")


def touched_parts(rows: DataFrame) -> list[str]:
    """The parts that rows fall into."""
    return sorted(row[PART] for row in rows.select(PART).distinct().collect())
