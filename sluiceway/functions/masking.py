"""Masking of tagged columns; the caller's groups come in as an argument."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway import config


def mask_pii(c: Column, groups: Collection[str], exempt: str = config.PII_UNMASK_GROUP) -> Column:
    """The value for members of the exempt group, a fixed text for all others, NULL included."""
    return c.cast("string") if exempt in groups else F.lit(config.MASK_TEXT)


def tag_columns(df: DataFrame, columns: Sequence[str], tags: Mapping[str, str]) -> DataFrame:
    """Attach tags to columns as field metadata; they travel with the columns."""
    return df.select(*[F.col(c).alias(c, metadata=dict(tags)) if c in columns else F.col(c) for c in df.columns])


def masked_view(
    df: DataFrame, tags: Mapping[str, str], groups: Collection[str], exempt: str = config.PII_UNMASK_GROUP
) -> DataFrame:
    """Mask every column that carries all of ``tags``."""
    tagged = {f.name for f in df.schema.fields if all(f.metadata.get(k) == v for k, v in tags.items())}
    return df.select(*[mask_pii(F.col(c), groups, exempt).alias(c) if c in tagged else F.col(c) for c in df.columns])


def rows_for_zones(df: DataFrame, zone_column: str, allowed: Sequence[str]) -> DataFrame:
    """Row-level filter: only the zones a reader may see."""
    return df.where(F.col(zone_column).isin(list(allowed)))
