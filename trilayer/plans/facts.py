"""Facts about a physical plan, and reuse of a result."""

from __future__ import annotations

import io
import re
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager, redirect_stdout
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@dataclass(frozen=True)
class PlanFacts:
    text: str
    nodes: Counter
    partition_filters: tuple[str, ...]
    pushed_filters: tuple[str, ...]
    read_schemas: tuple[str, ...]

    def has(self, node: str) -> bool:
        return self.nodes[node] > 0


def plan_facts(df: DataFrame) -> PlanFacts:
    """Operators, scan filters and scan schemas of the plan Spark chose."""
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    text = out.getvalue()
    tree = text.split("\n\n\n")[0]
    nodes = Counter(re.findall(r"([A-Z]\w+)(?: \w+)* *(?:\w+ )?\(\d+\)", tree))

    def listed(label: str) -> tuple[str, ...]:
        return tuple(
            found.strip()
            for found in re.findall(rf"^{label}: (.*)$", text, re.M)
            if found.strip() != "[]"
        )

    return PlanFacts(
        text=text,
        nodes=nodes,
        partition_filters=listed("PartitionFilters"),
        pushed_filters=listed("PushedFilters"),
        read_schemas=listed("ReadSchema"),
    )


@contextmanager
def cached(
    df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK
) -> Iterator[DataFrame]:
    """Keep a result for several aggregates and always let go of it."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()
