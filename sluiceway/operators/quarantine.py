"""Quarantine: rejected rows kept beside the good ones, with the reason."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.operators.rules import Rule, all_pass

FIRST = "first"
ALL = "all"


def first_reason(rule_set: Sequence[Rule]) -> Column:
    """The reason of the first broken rule, in rule order; NULL for a good row."""
    return F.coalesce(*[F.when(~rule.passes(), F.lit(rule.reason or rule.name)) for rule in rule_set])


def all_reasons(rule_set: Sequence[Rule]) -> Column:
    """The names of all broken rules, joined by a comma and a blank."""
    return F.concat_ws(", ", *[F.when(~rule.passes(), F.lit(rule.name)) for rule in rule_set])


def quarantine(
    df: DataFrame,
    rule_set: Sequence[Rule],
    processed_at: dt.datetime,
    mode: str = ALL,
    source_table: str | None = None,
) -> DataFrame:
    """Rows that break a rule. ``first`` names one reason and the source; ``all`` lists every rule."""
    rejected = df.where(~all_pass(rule_set))
    stamp = F.lit(processed_at).cast("timestamp")
    if mode == FIRST:
        return rejected.withColumns(
            {"quarantine_reason": first_reason(rule_set), "quarantined_at": stamp, "source_table": F.lit(source_table)}
        )
    return rejected.withColumns({"_quarantine_reason": all_reasons(rule_set), "_quarantined_at": stamp})


def with_verdict(df: DataFrame, rule_set: Sequence[Rule], processed_at: dt.datetime) -> DataFrame:
    """Mark every row good or bad, for one write that is partitioned by the verdict.

    Good rows carry NULL in both quarantine columns.
    """
    good = all_pass(rule_set)
    return df.withColumns(
        {
            "_quarantine_reason": F.when(~good, all_reasons(rule_set)),
            "_quarantined_at": F.when(~good, F.lit(processed_at).cast("timestamp")),
            "_verdict": F.when(good, F.lit("good")).otherwise(F.lit("bad")),
        }
    )


def good_rows(routed: DataFrame) -> DataFrame:
    return routed.where("_verdict = 'good'").drop("_verdict", "_quarantine_reason", "_quarantined_at")


def bad_rows(routed: DataFrame) -> DataFrame:
    return routed.where("_verdict = 'bad'").drop("_verdict")
