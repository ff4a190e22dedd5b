"""Data-quality rules: all rules of a table checked in one narrow pass, no Python per row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Literal, NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tradegrain.functions import passes

Action = Literal["warn", "drop", "quarantine", "fail"]
FAILED = "failed_rules"


@dataclass(frozen=True)
class Rule:
    """A row meets the rule only where `predicate` is TRUE; NULL counts as a violation.

    warn keeps the row (`warned` lists what it breaks), drop leaves it out, quarantine sets it aside, and fail
    ends the job.
    """
    name: str
    predicate: Column
    action: Action = "quarantine"

    @property
    def violated(self) -> Column:
        return ~passes(self.predicate)


class Split(NamedTuple):
    valid: DataFrame
    quarantine: DataFrame
    dropped: DataFrame


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the names of the rules that each row violates, as an array."""
    checked = df.withColumn(FAILED, F.filter(
        F.array(*[F.when(rule.violated, F.lit(rule.name)) for rule in rules]),
        lambda name: name.isNotNull()))
    for rule in rules:
        if rule.action == "fail":
            stop = F.raise_error(F.lit(f"rule {rule.name} is violated")).cast("boolean")
            checked = checked.filter(F.when(F.array_contains(FAILED, rule.name), stop)
                                     .otherwise(F.lit(True)))
    return checked


def _violates(rules: Sequence[Rule], action: Action) -> Column:
    names = [F.lit(r.name) for r in rules if r.action == action]
    return F.arrays_overlap(F.col(FAILED), F.array(*names)) if names else F.lit(False)


def split(checked: DataFrame, rules: Sequence[Rule]) -> Split:
    """Part checked rows three ways. A row that violates a quarantine rule is quarantined, once,
    whatever else it violates; of the others, one that violates a drop rule is dropped."""
    quarantined, dropped = (_violates(rules, action) for action in ("quarantine", "drop"))
    return Split(checked.filter(~quarantined & ~dropped).drop(FAILED),
                 checked.filter(quarantined),
                 checked.filter(dropped & ~quarantined))


def warned(checked: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows that stay although they break rules, with the names of these."""
    return checked.filter(~_violates(rules, "quarantine") & ~_violates(rules, "drop")
                          & (F.size(FAILED) > 0))


def violations(df: DataFrame, rules: Sequence[Rule], entity: str) -> DataFrame:
    """Violations per rule: one scan and one aggregate, turned into a row per rule."""
    counts = df.agg(*[F.count_if(rule.violated).alias(rule.name) for rule in rules])
    return (counts.unpivot([], [r.name for r in rules], "rule", "violations")
            .select(F.lit(entity).alias("entity"), "rule", "violations"))


def observed(checked: DataFrame, rules: Sequence[Rule], name: str
             ) -> tuple[DataFrame, Observation]:
    """Count rows and violations while the rows pass by, without a job of their own."""
    counters = Observation(name)
    return checked.observe(
        counters, F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.array_contains(FAILED, r.name)).alias(r.name) for r in rules]), counters
