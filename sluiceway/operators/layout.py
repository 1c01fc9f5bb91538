"""Row order on disk, so that readers can skip files and row groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cluster_rows(df: DataFrame, keys: Sequence[str], spread: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-partition by the keys and sort within: files with narrow key ranges, for small and medium tables.

    A hash of the ``spread`` columns is the last range column, so that one hot key is cut into
    several ranges instead of filling one partition. To find the ranges Spark samples the input,
    which computes its last stage twice.
    """
    ranges = [*[F.col(k) for k in keys], F.xxhash64(*spread)]
    placed = df.repartitionByRange(partitions, *ranges) if partitions else df.repartitionByRange(*ranges)
    return placed.sortWithinPartitions(*keys)


def gather_rows(df: DataFrame, keys: Sequence[str], spread: Sequence[str], lanes: int) -> DataFrame:
    """Bring rows of a key together and sort within, without sampling the input: for the largest tables.

    Rows are hashed by the keys and one of ``lanes`` lanes, taken from a hash of ``spread``. A key
    fills at most that many partitions, and a hot key is cut into as many pieces. Readers skip row
    groups by the sort order.
    """
    lane = F.pmod(F.xxhash64(*spread), F.lit(lanes))
    return df.repartition(*keys, lane).sortWithinPartitions(*keys)


def quantile_cuts(df: DataFrame, key: str, pieces: int, sample: int = 10_000) -> list:
    """Values that cut a column into pieces of about equal numbers of rows, from ``sample`` rows with the smallest hashes of all their columns.

    No more than the sample comes to the driver. NULLs are left out; a value that holds many rows is one cut.
    """
    drawn = df.where(F.col(key).isNotNull()).select(key, F.xxhash64(*df.columns).alias("_draw"))
    values = sorted(row[key] for row in drawn.orderBy("_draw").limit(sample).collect())
    return sorted({values[len(values) * i // pieces] for i in range(1, pieces)}) if values else []


def curve_place(df: DataFrame, keys: Sequence[str], bits: int = 6, sample: int = 10_000) -> Column:
    """A row's place on a curve that fills the space of its keys: the bits of the keys' quantile ranks, interleaved. NULL is in the lowest piece."""
    place = F.lit(0).cast("bigint")
    for k, key in enumerate(keys):
        cuts, kind = quantile_cuts(df, key, 2**bits, sample), df.schema[key].dataType
        passed = [F.when(F.col(key) >= F.lit(c).cast(kind), 1).otherwise(0) for c in cuts]
        rank = sum(passed, F.lit(0))
        for i in range(bits):
            bit = F.shiftright(rank, i).bitwiseAND(F.lit(1)).cast("bigint")
            place = place + F.shiftleft(bit, i * len(keys) + k)
    return place


def curve_rows(df: DataFrame, keys: Sequence[str], partitions: int | None = None, bits: int = 6, sample: int = 10_000) -> DataFrame:
    """Range-partition along a curve through all keys: files with narrow ranges of each of them, so that a filter on any one skips most.

    Of n files a filter on one value of one of k keys meets about n to the power (k - 1) / k. A hash of the row is the last range column, so one
    hot place is cut into several files. Keys of any type that can be ordered.
    """
    placed = df.withColumn("_place", curve_place(df, keys, bits, sample))
    ranges = [F.col("_place"), F.xxhash64(*df.columns)]
    dealt = placed.repartitionByRange(partitions, *ranges) if partitions else placed.repartitionByRange(*ranges)
    return dealt.sortWithinPartitions("_place").drop("_place")
