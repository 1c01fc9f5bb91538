"""One row per key for ever, with no event time and no state that grows: recent keys in a short list, older ones in buckets behind filters.

A stream's own state would keep every key in memory or on each executor's disk. Here each micro-batch keeps the keys it let through in a
list of its own; every few batches those lists are folded into a table of all keys, hashed into buckets, each with a Bloom filter of a fixed
rate of false hits. A batch asks the lists, then the filters, and joins exactly with the buckets whose filter says that a key may be there.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.config import Settings
from sluiceway.operators.dedup import keep_first
from sluiceway.sources.parted import PART, bucket, touched_parts
from sluiceway.sources.tables import children, few_rows, remove
from sluiceway.streaming.flows import BATCH
from sluiceway.streaming.steps import Steps

_PIECE = 32_768  # bits of one bitmap


def _places(key: str, bits: int, hashes: int) -> Column:
    """The bits of a key in its bucket's filter: ``hashes`` of them, by double hashing."""
    first, second = F.xxhash64(F.lit(1), key), F.xxhash64(F.lit(2), key)
    return F.array(*[F.pmod(F.pmod(first, F.lit(bits)) + F.lit(i) * F.pmod(second, F.lit(bits)), F.lit(bits)) for i in range(hashes)])


def bloom_filters(keys: DataFrame, key: str, bits: int, hashes: int) -> DataFrame:
    """``_part, piece, bitmap``: the filter of each part, in pieces of 32,768 bits; pieces without a bit are left out."""
    set_bits = keys.select(PART, F.explode(_places(key, bits, hashes)).alias("place"))
    return set_bits.groupBy(PART, F.expr(f"place div {_PIECE}").alias("piece")).agg(
        F.bitmap_construct_agg(F.col("place") % _PIECE).alias("bitmap")
    )


def may_hold(keys: DataFrame, filters: DataFrame, key: str, bits: int, hashes: int) -> DataFrame:
    """The keys whose bits are all set in their part's filter: every key that was put in, and few others."""
    asked = keys.select(PART, key, F.explode(_places(key, bits, hashes)).alias("place")).withColumn("piece", F.expr(f"place div {_PIECE}"))
    held = filters.select(F.col(PART).alias("_in"), F.col("piece").alias("_piece"), "bitmap")
    joined = asked.join(held, (F.col(PART) == F.col("_in")) & (F.col("piece") == F.col("_piece")))
    at = F.col("place") % _PIECE
    byte = F.conv(F.hex(F.substring("bitmap", F.expr(f"cast((place % {_PIECE}) div 8 AS int)") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.expr("shiftright(_byte, cast(_bit AS int)) & 1") == 1
    hits = joined.select(PART, key, byte.alias("_byte"), (at % 8).alias("_bit")).where(is_set)
    return hits.groupBy(PART, key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == hashes).select(PART, key)


class OnceRun(Steps):
    """The first row of each key of a stream, appended to ``{base}/appended/{name}``; copies may come any number of deliveries later.

    ``order`` picks the row among copies that arrive together; end it with every column that reaches the output. A NULL key is kept once, as any
    other. ``fold_every`` is the number of micro-batches whose keys stay in lists; then the buckets they fall into are read and written
    once. ``bucket_keys`` is the number of keys a bucket is expected to hold, and sizes its filter for one false hit in a hundred; more keys than that
    cost reads, never rows. ``route`` adds columns to the rows let through, by which ``partition_by`` may lay them out.
    """

    def __init__(
        self,
        spark: SparkSession,
        base: str,
        settings: Settings,
        name: str,
        key: str,
        order: Sequence[str],
        max_files: int = 1000,
        fold_every: int = 16,
        buckets: int = 256,
        bucket_keys: int = 1_000_000,
        route: Callable[[DataFrame], DataFrame] = lambda rows: rows,
        partition_by: Sequence[str] = (),
    ):
        super().__init__(spark, base, settings, max_files)
        self.name, self.key, self.order, self.fold_every, self.buckets = name, key, list(order), fold_every, buckets
        self.bits = _PIECE * max(1, math.ceil(bucket_keys * 9.6 / _PIECE))
        self.hashes = 7
        self.route, self.partition_by = route, list(partition_by)
        self.path, self.recent = f"{base}/appended/{name}", f"{base}/steps/{name}_recent"
        self.index = self.table(f"{name}_keys", "key string")
        self.filters = self.table(f"{name}_filters", "piece bigint, bitmap binary")
        self.asked: list[str] = []

    def _listed(self, number: int) -> list[int]:
        """The batches before this one whose keys are not folded yet."""
        folded = self.index.newest(before=number)
        found = [int(name.partition("=")[2]) for name in children(self.spark, self.recent) if name.startswith(f"{BATCH}=")]
        return sorted(n for n in found if n < number and (folded is None or n > folded))

    def _recent_keys(self, numbers: Sequence[int]) -> DataFrame:
        if not numbers:
            return few_rows(self.spark, [], "key string")
        return self.spark.read.schema("key string").parquet(*[f"{self.recent}/{BATCH}={n}" for n in numbers])

    def _known_before(self, keys: DataFrame, number: int) -> DataFrame:
        """Those of the keys that were folded: filters first, then an exact join with the buckets they point to."""
        parts = touched_parts(keys)
        filters = self.filters.read(parts, before=number, named=True)
        maybe = self.kept(may_hold(keys, filters, "key", self.bits, self.hashes))
        self.asked = touched_parts(maybe)
        there = self.index.read(self.asked, before=number).select(F.col("key").alias("_there"))
        return maybe.join(there, F.col("key").eqNullSafe(F.col("_there")), "left_semi").select("key")

    def _take(self, batch: DataFrame, number: int) -> None:
        firsts = self.kept(keep_first(batch, [self.key], self.order))
        listed, self.asked = self._listed(number), []
        seen = self._recent_keys(listed)
        if self.index.newest(before=number) is not None:
            named = firsts.select(F.col(self.key).cast("string").alias("key"))
            keys = self.kept(named.withColumn(PART, bucket(["key"], self.buckets)))
            seen = self.kept(seen.unionByName(self._known_before(keys, number)))
        seen = seen.select(F.col("key").alias("_seen"))
        new = firsts.join(seen, F.col(self.key).cast("string").eqNullSafe(F.col("_seen")), "left_anti")
        path = f"{self.path}/{BATCH}={number}"
        self.route(new).write.mode("overwrite").partitionBy(*self.partition_by).parquet(path)
        written = self.spark.read.schema(new.schema).parquet(path).select(F.col(self.key).cast("string").alias("key"))
        remove(self.spark, f"{self.recent}/{BATCH}={number}")  # of an earlier attempt
        if written.isEmpty():
            return
        written.write.mode("overwrite").parquet(f"{self.recent}/{BATCH}={number}")
        if len(listed) + 1 >= self.fold_every:
            self._fold([*listed, number], number)

    def _fold(self, numbers: Sequence[int], number: int) -> None:
        """Put the keys of these batches into the buckets; a batch that is repeated finds them unfolded again."""
        new = self.kept(self._recent_keys(numbers).withColumn(PART, bucket(["key"], self.buckets)))
        touched = touched_parts(new)
        whole = self.kept(self.index.read(touched, before=number, named=True).unionByName(new))
        self.filters.replace(bloom_filters(whole, "key", self.bits, self.hashes), touched, number)
        self.index.replace(whole, touched, number)
        before = self.index.newest(before=number)
        for name in children(self.spark, self.recent):
            if before is not None and name.startswith(f"{BATCH}=") and int(name.partition("=")[2]) <= before:  # a batch that is repeated needs only those after it
                remove(self.spark, f"{self.recent}/{name}")

    def run(self, stream: DataFrame) -> DataFrame:
        """Take everything that has arrived; returns all rows let through so far."""
        self.take(stream, f"once_{self.name}", self._take)
        return self.spark.read.schema(self.route(stream).schema).parquet(self.path).drop(BATCH)
