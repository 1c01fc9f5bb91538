"""Many layouts into one schema."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conform(df: DataFrame, mapping: Mapping[str, Column], tag_column: str, tag: str) -> DataFrame:
    """Project a source onto the shared schema and mark where its rows came from."""
    columns = [expression.alias(name) for name, expression in mapping.items()]
    return df.select(*columns, F.lit(tag).alias(tag_column))


def union_all(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """All rows of all frames, matched by column name. Works on streams as well."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def conform_sources(
    sources: Mapping[str, DataFrame], registry: Mapping[str, Mapping[str, Column]], tag_column: str
) -> DataFrame:
    """Run every registered source through its mapping; a new source is one more entry."""
    return union_all([conform(sources[name], mapping, tag_column, name) for name, mapping in registry.items()])


def explode_records(df: DataFrame, array_column: str, keep: list[str]) -> DataFrame:
    """One row per element of an array of structs, its fields as columns. NULL and empty arrays give no row."""
    return df.select(*keep, F.explode(array_column).alias("_record")).select(*keep, "_record.*")
