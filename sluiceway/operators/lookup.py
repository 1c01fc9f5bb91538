"""Joins against reference data, and what to do when the facts have a hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fits(df: DataFrame, max_bytes: int) -> bool:
    """Do the rows take at most ``max_bytes``, written as JSON?

    The check before a broadcast hint on a stream, which has no adaptive execution to measure, taken once when the
    stream starts. Beyond it the join is salted instead, with the same result. Give it a stored table or a short query
    over one: measuring runs a job.
    """
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))).alias("size")).first()["size"]
    return (size or 0) <= max_bytes


def lookup(
    fact: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    how: str = "left",
    spread: Sequence[str] = (),
    salts: int = 1,
) -> DataFrame:
    """Join reference columns to facts and drop the dimension's key.

    Without ``salts`` Spark picks the join: it broadcasts a dimension that is below its size limit,
    by the size of the stored table or by what adaptive execution has measured, and otherwise
    splits hot keys of a sort-merge join. A streaming plan cannot split, so ``salts`` spreads the
    facts by a hash of ``spread`` and repeats the dimension once per salt.
    """
    right = dimension.withColumnRenamed(dimension_key, "_lookup_key")
    if salts <= 1:
        return fact.join(right, F.col(fact_key) == F.col("_lookup_key"), how).drop("_lookup_key")
    salted = fact.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    repeated = right.withColumn("_lookup_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    on = (F.col(fact_key) == F.col("_lookup_key")) & (F.col("_salt") == F.col("_lookup_salt"))
    return salted.join(repeated, on, how).drop("_lookup_key", "_lookup_salt", "_salt")
