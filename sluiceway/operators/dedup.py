"""One row per key, and duplicate flags, on keys that may be very hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row per key.

    The filter on ``row_number = 1`` lets Spark drop all but one candidate per key in every map
    task (WindowGroupLimit), so a hot key reaches its reducer as one row per map task. End
    ``order`` with every column that reaches the output: then ties are equal rows.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def keep_latest(df: DataFrame, keys: Sequence[str], by: str, tie_break: Sequence[str] = ()) -> DataFrame:
    return keep_first(df, keys, [F.col(by).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tie_break]])


def flag_duplicates(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    spread: Sequence[str],
    salts: int,
    flag: str = "is_duplicate",
) -> DataFrame:
    """Keep every row; flag all but the first of each key.

    ``row_number() over (keys) > 1`` would pull a hot key into one task. Here the rows of a key
    are first ranked within ``salts`` lanes, taken from a hash of the ``spread`` columns. A row
    that is not first in its lane is a duplicate. The lane winners, at most ``salts`` per key, meet
    in a second window that finds the one first row; the losers stay spread over their lanes.
    Name a row id in ``spread`` if exact copies of one row can be many.
    """
    lane = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    in_lane = F.row_number().over(Window.partitionBy(*keys, "_lane").orderBy(*order))
    ranked = df.withColumn("_lane", lane).withColumn("_in_lane", in_lane)
    final = ranked.withColumn("_lane", F.when(F.col("_in_lane") == 1, F.lit(-1)).otherwise(F.col("_lane")))
    among_winners = F.row_number().over(Window.partitionBy(*keys, "_lane").orderBy(*order))
    return (
        final.withColumn("_among", among_winners)
        .withColumn(flag, (F.col("_in_lane") > 1) | (F.col("_among") > 1))
        .drop("_lane", "_in_lane", "_among")
    )
