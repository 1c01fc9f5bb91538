"""Data-quality rules: warn, drop, fail, measure.

A row passes a rule only where the predicate is TRUE. NULL counts as a failure, so kept and
rejected rows always add up to the input.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

WARN = "warn"
DROP = "drop"
FAIL = "fail"


@dataclass(frozen=True)
class Rule:
    """A named SQL predicate, what to do where it does not hold, and the words for a reject."""

    name: str
    predicate: str
    action: str = WARN
    reason: str | None = None

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def rules(action: str, **predicates: str) -> tuple[Rule, ...]:
    """Build rules of one action from ``name="predicate"`` pairs."""
    return tuple(Rule(name, predicate, action) for name, predicate in predicates.items())


def with_action(rule_set: Iterable[Rule], *actions: str) -> tuple[Rule, ...]:
    return tuple(rule for rule in rule_set if rule.action in actions)


def all_pass(rule_set: Iterable[Rule]) -> Column:
    """TRUE where every rule holds, else FALSE, never NULL."""
    return reduce(lambda left, right: left & right, (rule.passes() for rule in rule_set), F.lit(True))


def split(df: DataFrame, rule_set: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass all rules, and exactly the others."""
    good = all_pass(rule_set)
    return df.where(good), df.where(~good)


def keep_valid(df: DataFrame, rule_set: Sequence[Rule]) -> DataFrame:
    return df.where(all_pass(rule_set))


def keep_valid_parsed(df: DataFrame, rule_set: Sequence[Rule]) -> DataFrame:
    """``keep_valid`` for rules over columns that are costly to parse.

    The optimizer would move the filter below the projection that parses and repeat the parsing in
    every predicate. Here the verdict is a column of that projection, where common expressions are
    computed once, and the filter on it stays put (see ``fail_on_violation``).
    """
    stays = F.when(F.spark_partition_id() < 0, F.lit(False)).otherwise(F.col("_valid"))
    return df.withColumn("_valid", all_pass(rule_set)).where(stays).drop("_valid")


def _failure_counts(rule_set: Sequence[Rule]) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), *[F.count_if(~rule.passes()).alias(rule.name) for rule in rule_set]]


def observe(df: DataFrame, rule_set: Sequence[Rule], name: str | None = None) -> tuple[DataFrame, Observation]:
    """Count failures per rule while the frame is computed anyway; no pass of its own.

    Read ``observation.get`` after the action that writes the frame. Put it above a range
    partitioning: that one samples its input, and rows below it would be counted twice.
    """
    observation = Observation(name) if name else Observation()
    return df.observe(observation, *_failure_counts(rule_set)), observation


def observe_stream(stream: DataFrame, rule_set: Sequence[Rule], name: str) -> DataFrame:
    """The same on a stream; the counts of each micro-batch are in the query's progress under ``name``."""
    return stream.observe(name, *_failure_counts(rule_set))


def fail_on_violation(df: DataFrame, rule_set: Sequence[Rule]) -> DataFrame:
    """Stop the job at the first row that breaks a rule, with the rule's name in the error.

    The optimizer may move a plain filter below joins and other filters, where it would meet rows
    that never reach this frame and stop on them. It leaves a filter that is not deterministic
    where it stands; the partition number, never below zero, is there for that alone.
    """
    if not rule_set:
        return df
    verdict = F.when(F.spark_partition_id() < 0, F.lit(False))
    for rule in rule_set:
        stop = F.raise_error(F.lit(f"rule {rule.name} is broken: {rule.predicate}")).cast("boolean")
        verdict = verdict.when(~rule.passes(), stop)
    return df.where(verdict.otherwise(F.lit(True)))


def enforce(df: DataFrame, rule_set: Sequence[Rule]) -> DataFrame:
    """Drop by the drop rules and stop on the fail rules; warn rules change nothing."""
    return fail_on_violation(keep_valid(df, with_action(rule_set, DROP)), with_action(rule_set, FAIL))


def enforce_observed(df: DataFrame, rule_set: Sequence[Rule], name: str | None = None):
    """``enforce`` with failure counts of all rules taken on the way, before any row is dropped."""
    watched, observation = observe(df, rule_set, name)
    return enforce(watched, rule_set), observation


def flag_known(df: DataFrame, column: str, keys: DataFrame, key: str, flag: str = "_known_zone") -> DataFrame:
    """Add ``flag``: is ``column`` among the values of ``keys.key``? NULL is not known.

    A left join on the distinct keys; the join can neither drop nor repeat a row.
    """
    known = keys.select(F.col(key).alias("_key")).where("_key IS NOT NULL").distinct().withColumn("_hit", F.lit(True))
    joined = df.join(known, F.col(column) == F.col("_key"), "left")
    return joined.withColumn(flag, F.coalesce("_hit", F.lit(False))).drop("_key", "_hit")


def metric_rows(rule_set: Sequence[Rule], dataset: str, counts: Mapping[str, int]) -> list[tuple]:
    """Observed counts as rows of (dataset, rule, action, passed, failed)."""
    rows = counts["rows"]
    return [(dataset, r.name, r.action, rows - counts[r.name], counts[r.name]) for r in rule_set]


def dq_metrics(df: DataFrame, rule_set: Sequence[Rule], dataset: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per rule (and per group): rows passed, failed, and the failed share in percent.

    All rules are counted in one aggregation, which is then turned from columns to rows.
    """
    counts = [F.count_if(~rule.passes()).alias(f"_failed_{i}") for i, rule in enumerate(rule_set)]
    wide = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"), *counts)
    entry = F.array(
        *[
            F.struct(
                F.lit(rule.name).alias("rule"), F.lit(rule.action).alias("action"), F.col(f"_failed_{i}").alias("failed")
            )
            for i, rule in enumerate(rule_set)
        ]
    )
    rows = wide.select(*by, "_rows", F.explode(entry).alias("m"))
    share = F.when(
        F.col("_rows") > 0,
        F.round((F.col("m.failed") * 100).cast("decimal(22,0)") / F.col("_rows").cast("decimal(20,0)"), 2),
    )
    return rows.select(
        F.lit(dataset).alias("dataset"),
        *by,
        F.col("m.rule").alias("rule"),
        F.col("m.action").alias("action"),
        (F.col("_rows") - F.col("m.failed")).alias("passed"),
        F.col("m.failed").alias("failed"),
        share.cast("double").alias("failed_pct"),
    )
