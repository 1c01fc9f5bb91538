"""Column and key profiles in one aggregation each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.measures import percent


def profile_columns(df: DataFrame, columns: Sequence[str], dataset: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows, NULLs and empty texts of each column, whole or per group."""
    text = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    counts = []
    for i, c in enumerate(columns):
        counts.append(F.count_if(F.col(c).isNull()).alias(f"_null_{i}"))
        is_empty = F.col(c) == "" if c in text else F.lit(False)
        counts.append(F.count_if(is_empty).alias(f"_empty_{i}"))
    wide = df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"), *counts)
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(f"_null_{i}").alias("nulls"), F.col(f"_empty_{i}").alias("empties"))
        for i, c in enumerate(columns)
    ]
    rows = wide.select(*by, "row_count", F.explode(F.array(*entries)).alias("p"))
    return rows.select(
        F.lit(dataset).alias("dataset"),
        *by,
        F.col("p.column").alias("column_name"),
        "row_count",
        F.col("p.nulls").alias("null_count"),
        F.col("p.empties").alias("empty_count"),
        percent("p.nulls", "row_count").alias("null_pct"),
    )


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


#: Of an estimate of distinct values: relative standard error 1.04 / sqrt(2^12), 1.6 %; of a quantile: 1.7 % of all ranks, at 99 % confidence.
DISTINCT_ERROR, RANK_ERROR = 0.0163, 0.017


def value_sketches(df: DataFrame, columns: Sequence[str], dataset: str) -> DataFrame:
    """``dataset, column_name, row_count, null_count, distinct_sketch, quantile_sketch`` of each column, in one aggregation. Sketches have a fixed
    size; keep those of each batch, and merge them. Text columns have no quantiles."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    parts = []
    for i, c in enumerate(columns):
        number = F.col(c).cast("double") if kinds[c] not in ("string", "date", "boolean") else F.lit(None).cast("double")
        parts += [
            F.count_if(F.col(c).isNull()).alias(f"_null_{i}"),
            F.hll_sketch_agg(F.col(c).cast("string"), 12).alias(f"_distinct_{i}"),
            F.kll_sketch_agg_double(number).alias(f"_quantile_{i}"),
        ]
    wide = df.agg(F.count(F.lit(1)).alias("row_count"), *parts)
    entries = [
        F.struct(
            F.lit(c).alias("column_name"), F.col(f"_null_{i}").alias("null_count"),
            F.col(f"_distinct_{i}").alias("distinct_sketch"), F.col(f"_quantile_{i}").alias("quantile_sketch"),
        )
        for i, c in enumerate(columns)
    ]
    return wide.select(F.lit(dataset).alias("dataset"), "row_count", F.explode(F.array(*entries)).alias("p")).select("dataset", "row_count", "p.*")


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """Sketches of several batches as one row a column."""
    return sketches.groupBy("dataset", "column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
    )


def value_profile(sketches: DataFrame, quantiles: Sequence[float] = (0.05, 0.5, 0.95)) -> DataFrame:
    """What merged sketches say: counts, an estimate of the number of distinct values, and of quantiles (NULL without a number)."""
    some = F.kll_sketch_get_n_double("quantile_sketch") > 0
    cut = [
        F.when(some, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(float(q)))).alias(f"q{round(q * 100):02d}") for q in quantiles
    ]
    return sketches.select(
        "dataset", "column_name", "row_count", "null_count", F.hll_sketch_estimate("distinct_sketch").alias("distinct_values"), *cut
    )
