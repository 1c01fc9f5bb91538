"""Majority vote: which label does a key carry most often, and how sure is that?"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.measures import percent


def votes(df: DataFrame, key: str, label: str) -> DataFrame:
    """Rows per key and label. Rows without a key cannot be resolved and are left out openly."""
    return df.where(F.col(key).isNotNull()).groupBy(key, label).agg(F.count(F.lit(1)).alias("votes"))


def merge_votes(old: DataFrame, new: DataFrame, key: str, label: str) -> DataFrame:
    """Add the counts of a new batch to stored ones, so that history is not read again."""
    return old.unionByName(new).groupBy(key, label).agg(F.sum("votes").alias("votes"))


def resolve(counted: DataFrame, key: str, label: str, threshold: float) -> DataFrame:
    """The most frequent label per key, its share in percent, and whether that is below ``threshold``.

    Both steps, counting and picking, are aggregations with map-side partials; no window and no
    self-join. Equal counts go to the smaller label, a missing label losing against any other.
    """
    best = F.min(F.struct((-F.col("votes")).alias("n"), F.col(label).isNull().alias("missing"), F.col(label)))
    picked = counted.groupBy(key).agg(best.alias("best"), F.sum("votes").alias("total"))
    share = percent(-F.col("best.n"), F.col("total"))
    return picked.select(
        key,
        F.col(f"best.{label}").alias(f"resolved_{label}"),
        share.alias("confidence_pct"),
        (share < F.lit(float(threshold))).alias("is_ambiguous"),
    )


def zone_uncertain(zone: str = "zone", resolved: str = "resolved_zone", ambiguous: str = "is_ambiguous") -> Column:
    """Uncertain if unresolved, resolved with low confidence, or named otherwise by the reading.

    A reading that names no zone does not disagree.
    """
    differs = F.coalesce(F.col(zone) != F.col(resolved), F.lit(False))
    return F.col(resolved).isNull() | F.coalesce(F.col(ambiguous), F.lit(False)) | differs


def months_since(as_of: dt.date, month: Column | str) -> Column:
    """Whole months between a month and the day of the run, cut toward zero."""
    return F.months_between(F.lit(as_of), month).cast("int")
