"""Row rules that warn, drop or fail, with counts per rule."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trilayer.operators.cleanse import holds


@dataclass(frozen=True)
class Rule:
    """``condition`` must be true for a row to pass; unknown counts as a violation."""

    name: str
    condition: str
    action: Literal["warn", "drop", "fail"] = "warn"


class RuleViolation(ValueError):
    """A fail rule is broken."""


def rule_metrics(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: rule, action, passed, failed. One pass over ``df``.

    Every rule is counted on the rows given, before any rule drops some.
    """
    actions = F.create_map(
        *[F.lit(part) for rule in rules for part in (rule.name, rule.action)]
    )
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(~holds(rule.condition)).alias(rule.name) for rule in rules],
    )
    return counts.unpivot("_rows", [rule.name for rule in rules], "rule", "failed").select(
        "rule",
        F.element_at(actions, F.col("rule")).alias("action"),
        (F.col("_rows") - F.col("failed")).alias("passed"),
        "failed",
    )


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``df`` under the rules; works on batches and on streams.

    A broken fail rule ends the job that reads the result. Fail rules look at every
    row, before drop rules remove any; check_rules() does so before anything is written.
    """
    checks = F.spark_partition_id() >= 0
    for rule in rules:
        if rule.action == "fail":
            stop = F.raise_error(f"rule {rule.name} failed: {rule.condition}").cast("boolean")
            checks = checks & F.when(holds(rule.condition), True).otherwise(stop)
    if any(rule.action == "fail" for rule in rules):
        # The partition id makes the filter non-deterministic: the optimizer then
        # neither merges it with later filters nor moves them below it.
        df = df.filter(checks)
    for rule in rules:
        if rule.action == "drop":
            df = df.filter(holds(rule.condition))
    return df


def check_rules(df: DataFrame, rules: Sequence[Rule]) -> None:
    """Raise if any row of ``df`` breaks a fail rule; to be called before a write."""
    fail_rules = [rule for rule in rules if rule.action == "fail"]
    if not fail_rules:
        return
    # One row per rule.
    broken = rule_metrics(df, fail_rules).filter("failed > 0").collect()
    if broken:
        raise RuleViolation(
            "; ".join(f"{row['rule']}: {row['failed']} rows" for row in broken)
        )


def observe_rules(df: DataFrame, rules: Sequence[Rule], name: str = "rules") -> DataFrame:
    """Count violations while the rows pass by; read them from the query progress."""
    return df.observe(
        name,
        F.count("*").alias("rows"),
        *[F.count_if(~holds(rule.condition)).alias(rule.name) for rule in rules],
    )
