"""What changed between two snapshots, found by digests first: only rows in buckets that differ are joined.

A digest is the sum of the hashes of a bucket's rows, whatever their order, so it needs one aggregation with map-side partials and
no row crosses the network for it. Buckets are compared coarse first, then fine within those that differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_EXACT = "decimal(20,0)"


def fine_bucket(key: str, fine: int) -> Column:
    """The bucket of a key; NULL has one too."""
    return F.pmod(F.xxhash64(key), F.lit(fine)).cast("int")


def digests(df: DataFrame, key: str, columns: Sequence[str], fine: int) -> DataFrame:
    """``bucket, rows, low, high`` for every fine bucket of a snapshot: sums of two hashes of each row. Store them beside the snapshot,
    and the next comparison need not read it again.

    Rows that differ give other sums but for a chance of 2^-64 for each hash.
    """
    whole = F.xxhash64(key, *columns)
    other = F.xxhash64(F.lit(0x5BD1E995), *reversed([key, *columns]))
    return df.groupBy(fine_bucket(key, fine).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(whole.cast(_EXACT)).alias("low"), F.sum(other.cast(_EXACT)).alias("high")
    )


def _differing(before: DataFrame, after: DataFrame) -> DataFrame:
    """Buckets whose digests are not equal, those of one side only among them."""
    tagged = before.withColumn("side", F.lit(1)).unionByName(after.withColumn("side", F.lit(-1)))
    sums = [F.sum(F.col(c) * F.col("side")).alias(c) for c in ("rows", "low", "high")]
    return tagged.groupBy("bucket").agg(*sums).where("rows <> 0 OR low <> 0 OR high <> 0").select("bucket")


def changed_buckets(before: DataFrame, after: DataFrame, coarse: int) -> DataFrame:
    """The fine buckets that differ between two snapshots' digests. Coarse ones, ``coarse`` in all, are compared first; fine ones only within those
    that differ."""

    def rolled(digest: DataFrame) -> DataFrame:
        return digest.groupBy(F.pmod("bucket", F.lit(coarse)).alias("bucket")).agg(*[F.sum(c).alias(c) for c in ("rows", "low", "high")])

    suspect = _differing(rolled(before), rolled(after)).withColumnRenamed("bucket", "suspect")
    held = [d.join(suspect, F.pmod("bucket", F.lit(coarse)) == F.col("suspect"), "left_semi") for d in (before, after)]
    return _differing(*held)


def snapshot_changes(
    before: DataFrame,
    after: DataFrame,
    key: str,
    fine: int = 65536,
    coarse: int = 256,
    digest_before: DataFrame | None = None,
    digest_after: DataFrame | None = None,
) -> DataFrame:
    """What changed between two snapshots with one row per key: insert, delete, and both images of an update.

    Rows of buckets with equal digests are filtered out in the scan and never shuffled; the others are joined by key. A NULL key is a key like
    any other: it is inserted, deleted and updated as one row. Columns of ``after`` are compared; ``before`` must have them too.
    """
    columns = [c for c in after.columns if c != key]
    old_digest = digest_before or digests(before, key, columns, fine)
    new_digest = digest_after or digests(after, key, columns, fine)
    changed = changed_buckets(old_digest, new_digest, coarse)

    def suspects(df: DataFrame, side: str) -> DataFrame:
        rows = df.withColumn("_bucket", fine_bucket(key, fine)).join(changed, F.col("_bucket") == F.col("bucket"), "left_semi")
        return rows.select(F.col("_bucket").alias(f"_{side}_bucket"), F.struct(F.col(key).alias("key")).alias(f"_{side}_key"), F.struct(*columns).alias(f"_{side}"))

    old, new = suspects(before, "old"), suspects(after, "new")
    # The bucket is an equi-join key that NULL keys have as well.
    same = (F.col("_old_bucket") == F.col("_new_bucket")) & F.col("_old_key").eqNullSafe(F.col("_new_key"))
    joined = old.join(new, same, "full_outer")

    def image(kind: str, side: str) -> Column:
        return F.struct(F.lit(kind).alias("_change_type"), F.col(f"_{side}_key.key").alias(key), F.col(f"_{side}").alias("row"))

    images = (
        F.when(F.col("_old_bucket").isNull(), F.array(image("insert", "new")))
        .when(F.col("_new_bucket").isNull(), F.array(image("delete", "old")))
        .when(~F.col("_old").eqNullSafe(F.col("_new")), F.array(image("update_preimage", "old"), image("update_postimage", "new")))
    )
    return joined.select(F.explode(images).alias("c")).select("c._change_type", f"c.{key}", "c.row.*")
