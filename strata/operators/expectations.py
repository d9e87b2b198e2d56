"""Declarative row rules: ``warn`` counts, ``drop`` removes, ``fail`` stops the run."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.functions import is_true

ACTIONS = ("warn", "drop", "fail")


class ExpectationFailed(RuntimeError):
    """A ``fail`` rule did not hold."""


@dataclass(frozen=True)
class Rule:
    """``condition``, a column or SQL text, holds for good rows; null counts as not holding."""

    name: str
    condition: Column | str
    action: str = "warn"

    def __post_init__(self) -> None:
        if self.action not in ACTIONS:
            raise ValueError(f"action {self.action!r} is none of {ACTIONS}")

    @property
    def holds(self) -> Column:
        text = isinstance(self.condition, str)
        return is_true(F.expr(self.condition) if text else self.condition)

    @property
    def failed_rows(self) -> Column:
        return F.count_if(~self.holds)


def _hold(rules: Sequence[Rule]) -> Column:
    held = F.lit(True)
    for rule in rules:
        held = held & rule.holds
    return held


def expectations_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with the rows checked and failed, from one pass over the data."""
    counts = df.agg(
        F.count("*").alias("checked_rows"),
        *[rule.failed_rows.alias(f"failed_{i}") for i, rule in enumerate(rules)],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(rule.name).alias("rule"),
                F.lit(rule.action).alias("action"),
                F.col(f"failed_{i}").alias("failed_rows"),
            )
            for i, rule in enumerate(rules)
        ]
    )
    return counts.select(F.inline(entries), "checked_rows")


def drop_failing(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that meet every ``drop`` rule."""
    return df.filter(_hold([r for r in rules if r.action == "drop"]))


def stop_on_failing(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The same rows; the first row that breaks a ``fail`` rule ends the job.

    The test is a filter, so no later column pruning can remove it.
    """
    for rule in rules:
        if rule.action == "fail":
            stop = F.raise_error(F.lit(f"expectation {rule.name} failed")).cast("boolean")
            df = df.filter(F.when(rule.holds, F.lit(True)).otherwise(stop))
    return df


def observe_rules(df: DataFrame, rules: Sequence[Rule], counts: Observation) -> DataFrame:
    """Count failing rows of every rule while another job runs over ``df``.

    After that job ``counts.get`` holds the rows by rule name, and all rows as ``checked_rows``.
    """
    return df.observe(
        counts,
        F.count(F.lit(1)).alias("checked_rows"),
        *[rule.failed_rows.alias(rule.name) for rule in rules],
    )


def raise_for(counts: dict[str, int], rules: Sequence[Rule]) -> None:
    """Raise if a ``fail`` rule has failing rows in the observed counts."""
    broken = {r.name: counts[r.name] for r in rules if r.action == "fail" and counts[r.name]}
    if broken:
        raise ExpectationFailed(f"rows that break fail rules: {broken}")
