"""Slowly changing dimensions, versions of reference rows, and snapshot differences."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.operators.dedup import keep_latest


def latest_version(df: DataFrame, key: str, period: str, columns: Sequence[str]) -> DataFrame:
    """Type 1: the newest row per key. Ties go to the greater values, a missing value losing."""
    return keep_latest(df.select(key, period, *columns), [key], period, columns).select(key, *columns)


def versions(
    df: DataFrame, key: str, period: str, columns: Sequence[str], null_safe: bool = True
) -> DataFrame:
    """Type 2 history from dated snapshots: a version starts where a tracked value changes.

    Rows are first reduced to one per key and day by an aggregation, so the ordered window that
    follows holds at most one row per day for a key, however often the key occurs. On equal days
    the greater values win. ``null_safe=False`` compares with plain ``<>``: a change to or from
    NULL is then missed, except that a missing first column always counts as a change.
    """
    daily = (
        df.groupBy(key, period)
        .agg(F.max(F.struct(*columns)).alias("now"))
        .withColumn("before", F.lag("now").over(Window.partitionBy(key).orderBy(period)))
    )
    if null_safe:
        changed = ~F.col("now").eqNullSafe(F.col("before"))
    else:
        differs = [F.coalesce(F.col(f"now.{c}") != F.col(f"before.{c}"), F.lit(False)) for c in columns]
        changed = reduce(lambda a, b: a | b, differs, F.col(f"before.{columns[0]}").isNull())
    following = F.lead(period).over(Window.partitionBy(key).orderBy(period))
    return (
        daily.where(changed)
        .withColumn("effective_to", F.date_sub(following, 1))
        .select(
            key,
            *[F.col(f"now.{c}").alias(c) for c in columns],
            F.col(period).alias("effective_from"),
            "effective_to",
            F.col("effective_to").isNull().alias("is_current"),
        )
    )


def daily_rows(df: DataFrame, key: str, period: str, columns: Sequence[str]) -> DataFrame:
    """One row per key and day, as ``versions`` takes them: ``key, day, now``; on equal days the greater values win."""
    return df.groupBy(key, F.col(period).alias("day")).agg(F.max(F.struct(*columns)).alias("now"))


def dated_versions(daily: DataFrame, key: str) -> DataFrame:
    """Type 2 history that can take later deliveries: each version also holds the ``days`` of its snapshots.

    ``daily`` is of ``daily_rows``. The windows and arrays hold at most one entry a day for a key.
    """
    by_day = Window.partitionBy(key).orderBy("day")
    opens = (F.row_number().over(by_day) == 1) | ~F.col("now").eqNullSafe(F.lag("now").over(by_day))
    numbered = daily.withColumn("opens", opens).withColumn("number", F.sum(F.col("opens").cast("int")).over(by_day))
    spans = numbered.groupBy(key, "number").agg(
        F.max("now").alias("now"), F.sort_array(F.collect_list(F.struct("day"))).alias("days")
    )
    following = F.lead(F.element_at("days", 1)["day"]).over(Window.partitionBy(key).orderBy("number"))
    return spans.select(
        key,
        "now.*",
        F.element_at("days", 1)["day"].alias("effective_from"),
        F.date_sub(following, 1).alias("effective_to"),
        F.date_sub(following, 1).isNull().alias("is_current"),
        F.col("days.day").alias("days"),
    )


def merge_versions(stored: DataFrame, daily: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Stored ``dated_versions`` with a delivery of ``daily_rows`` merged in; the result is what all days together give.

    A new last day closes the open version or lengthens it; a late day splits the version it falls into, moves a boundary, or joins two
    equal neighbours. Only keys that the delivery names are taken apart into days; the others pass as they are.
    """
    named = daily.select(F.col(key).alias("_named")).distinct()
    same = F.col(key) == F.col("_named")
    theirs = stored.join(named, same, "left_semi").select(key, F.explode("days").alias("day"), F.struct(*columns).alias("now"))
    days = theirs.unionByName(daily.select(key, "day", "now")).groupBy(key, "day").agg(F.max("now").alias("now"))
    return stored.join(named, same, "left_anti").unionByName(dated_versions(days, key))


def version_faults(df: DataFrame, key: str) -> DataFrame:
    """Keys whose history is broken: not one current version, overlapping spans, or from > to.

    Equal spans are counted into one row before the window. The copies of a span overlap each
    other, and the last one may overlap the next span.
    """
    span = ["effective_from", "effective_to", "is_current"]
    end = F.coalesce("effective_to", F.lit(dt.date(9999, 12, 31)))
    ordered = Window.partitionBy(key).orderBy("effective_from", F.col("effective_to").asc_nulls_last(), "is_current")
    spans = (
        df.groupBy(key, *span)
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("following", F.lead("effective_from").over(ordered))
    )
    among_copies = F.when(end >= F.col("effective_from"), F.col("copies") - 1).otherwise(0)
    into_next = F.when(end >= F.col("following"), 1).otherwise(0)
    inverted = F.when(F.col("effective_from") > F.col("effective_to"), F.col("copies")).otherwise(0)
    return (
        spans.groupBy(key)
        .agg(
            F.sum("copies").alias("version_count"),
            F.sum(F.when(F.col("is_current"), F.col("copies")).otherwise(0)).alias("current_count"),
            F.sum(among_copies + into_next).alias("overlap_count"),
            F.sum(inverted).alias("inverted_count"),
        )
        .where("current_count <> 1 OR overlap_count > 0 OR inverted_count > 0")
    )


def current(df: DataFrame) -> DataFrame:
    return df.where("is_current")


def merge_insert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Insert-only merge: rows of ``source`` whose key is new; existing rows are never touched."""
    return target.unionByName(source.join(target.select(key), key, "left_anti"))


def add_version(target: DataFrame, row: DataFrame) -> DataFrame:
    return target.unionByName(row)


def retire(target: DataFrame, closing: Column, on: dt.date) -> DataFrame:
    """End the current version of the rows where ``closing`` holds."""
    hit = F.col("is_current") & F.coalesce(closing, F.lit(False))
    return target.withColumns(
        {
            "effective_to": F.when(hit, F.lit(on)).otherwise(F.col("effective_to")),
            "is_current": F.col("is_current") & ~hit,
        }
    ).select(*target.columns)


def snapshot_diff(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """What changed between two snapshots with one row per key: insert, delete, and both images of an update."""
    columns = [c for c in after.columns if c != key]
    old = before.select(F.col(key).alias("_old_key"), F.struct(*columns).alias("_old"))
    new = after.select(F.col(key).alias("_new_key"), F.struct(*columns).alias("_new"))
    joined = old.join(new, F.col("_old_key") == F.col("_new_key"), "full_outer")

    def image(kind: str, side: str) -> Column:
        return F.struct(
            F.lit(kind).alias("_change_type"), F.col(f"_{side}_key").alias(key), F.col(f"_{side}").alias("row")
        )

    images = (
        F.when(F.col("_old_key").isNull(), F.array(image("insert", "new")))
        .when(F.col("_new_key").isNull(), F.array(image("delete", "old")))
        .when(
            ~F.col("_old").eqNullSafe(F.col("_new")),
            F.array(image("update_preimage", "old"), image("update_postimage", "new")),
        )
    )
    return joined.select(F.explode(images).alias("c")).select("c._change_type", f"c.{key}", "c.row.*")


def erase(df: DataFrame, erased: DataFrame, key: str) -> DataFrame:
    """Remove every version of the keys on an erasure list."""
    return df.join(erased.select(key).distinct(), key, "left_anti")


def retain(df: DataFrame, ended_on: str, cutoff: dt.date) -> DataFrame:
    """Keep versions that are open or ended on or after the cut-off."""
    return df.where(F.col(ended_on).isNull() | (F.col(ended_on) >= F.lit(cutoff)))


def as_of_version(facts: DataFrame, versions_: DataFrame, key: str, day: str, columns: Sequence[str]) -> DataFrame:
    """Facts with the details in force on their day; facts older than the first version are left out.

    Days that occur in facts are resolved once per key and day: version starts and fact days go
    through one ordered window that carries the last version forward, at most two rows per key
    and day. The result is joined back to the facts by key and day.
    """
    starts = versions_.select(
        key, F.col("effective_from").alias("_day"), F.struct(*columns, "effective_to").alias("_version")
    )
    unknown = F.lit(None).cast(starts.schema["_version"].dataType)
    asked = facts.select(key, F.col(day).alias("_day")).distinct().withColumn("_version", unknown)
    ordered = Window.partitionBy(key).orderBy("_day", F.col("_version").isNull())
    carried = starts.unionByName(asked).withColumn("_held", F.last("_version", ignorenulls=True).over(ordered))
    in_force = F.col("_held.effective_to").isNull() | (F.col("_held.effective_to") >= F.col("_day"))
    resolved = carried.where(F.col("_version").isNull() & F.col("_held").isNotNull() & in_force).select(
        key, F.col("_day").alias(day), *[F.col(f"_held.{c}").alias(c) for c in columns]
    )
    return facts.join(resolved, [key, day])
