"""Distinct counts that add up: numbered keys and bitmaps that can be merged, exactly.

A distinct count cannot be added to another; the bitmap of the numbers of its keys can be or-ed with another one. Bitmaps are cut into pieces
of 32,768 numbers, so a group's bitmap is spread over rows and merges row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.sources.parted import PART, PartedTable, bucket, touched_parts


def number_keys(table: PartedTable, keys: DataFrame, key: str, buckets: int, run: int) -> DataFrame:
    """Give every key of a delivery that has no number one, for good, and return the numbers of the delivery's keys: ``key, number``.

    ``table`` holds key and number in hash buckets; only those of the delivery are read. The n-th key of bucket b gets n * buckets + b, so numbers
    stay dense and no two runs or buckets give the same one. A NULL key has no number.
    """
    wanted = keys.where(F.col(key).isNotNull()).select(bucket([key], buckets).alias(PART), key).distinct()
    touched = touched_parts(wanted)
    known = table.read(touched, before=run).withColumn(PART, bucket([key], buckets))
    new = wanted.join(known.select(F.col(key).alias("_known")), F.col(key) == F.col("_known"), "left_anti")
    taken = known.groupBy(F.col(PART).alias("_in")).agg(F.count(F.lit(1)).alias("_taken"))
    place = F.row_number().over(Window.partitionBy(PART).orderBy(key)) - 1 + F.coalesce("_taken", F.lit(0))
    at = F.substring(PART, 2, 18).cast("bigint")
    numbered = new.join(taken, F.col(PART) == F.col("_in"), "left").withColumn("number", (place * buckets + at).cast("bigint"))
    table.replace(known.select(PART, key, "number").unionByName(numbered.select(PART, key, "number")), touched, run)
    after = table.read(touched)
    return after.join(wanted.select(F.col(key).alias("_wanted")), F.col(key) == F.col("_wanted"), "left_semi").select(key, "number")


def bitmaps(numbered: DataFrame, group: Sequence[str], number: str = "number") -> DataFrame:
    """``group, piece, bitmap`` of the numbers in each group; rows without a number count nothing."""
    rows = numbered.where(F.col(number).isNotNull())
    return rows.groupBy(*group, F.bitmap_bucket_number(number).alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap")
    )


def merged(pieces: DataFrame, group: Sequence[str]) -> DataFrame:
    """Pieces of the same group, or of groups that ``group`` puts together, as one."""
    return pieces.groupBy(*group, "piece").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_count(pieces: DataFrame, group: Sequence[str], name: str) -> DataFrame:
    """The exact number of different keys per group, from any pieces: of several months, zones or runs."""
    return merged(pieces, group).groupBy(*group).agg(F.sum(F.bitmap_count("bitmap")).cast("bigint").alias(name))
