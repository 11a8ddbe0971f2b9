"""Upserts with conditional update, delete and insert clauses.

Plain Parquet tables cannot be changed in place, so a merge is a new DataFrame
that the caller writes to a new path.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from trilayer.operators.joins import row_bytes, within_limits
from trilayer.sources.writers import write_layer


@dataclass(frozen=True)
class Clause:
    """One WHEN clause. Expressions refer to the target as ``t``, the source as ``s``."""

    matched: bool
    action: str
    condition: str | None = None
    values: Mapping[str, str] = field(default_factory=dict)


def when_matched_update(values: Mapping[str, str], condition: str | None = None) -> Clause:
    """Set the named target columns."""
    return Clause(True, "update", condition, values)


def when_matched_delete(condition: str | None = None) -> Clause:
    return Clause(True, "delete", condition)


def when_not_matched_insert(
    values: Mapping[str, str] | None = None, condition: str | None = None
) -> Clause:
    """Insert the source row; target columns not named become null.

    Without ``values``, columns are taken from the source by name.
    """
    return Clause(False, "insert", condition, values or {})


def _acting_rows(source: DataFrame, clauses: Sequence[Clause]) -> DataFrame:
    """Source rows that some clause may act on, as far as the source alone can tell."""
    aliased = source.alias("s")
    conditions = []
    for clause in clauses:
        if clause.condition is None or re.search(r"\bt\b", clause.condition):
            return source
        try:
            aliased.filter(clause.condition)
        except AnalysisException:
            return source  # a column of the target, without its alias
        conditions.append(F.expr(clause.condition))
    return aliased.filter(reduce(or_, conditions)).select(*source.columns)


class DuplicateKeys(ValueError):
    """Several source rows would change the same target row."""


def _latest_per_key(
    source: DataFrame, on: Sequence[str], dedupe_by: Sequence[str]
) -> DataFrame:
    """The latest source row of each key; rows with a null key all stay."""
    has_key = reduce(and_, [F.col(name).isNotNull() for name in on])
    latest = F.max_by(F.struct(*source.columns), F.struct(*dedupe_by)).alias("_row")
    keyed = source.filter(has_key).groupBy(*on).agg(latest).select("_row.*")
    return keyed.unionByName(source.filter(~has_key))


def _measure(source: DataFrame, on: Sequence[str]) -> tuple[bool, bool]:
    """Whether the source is small, and whether keys repeat in it, in one job over it."""
    has_key = reduce(and_, [F.col(name).isNotNull() for name in on])
    per_key = source.groupBy(*on).agg(
        F.count("*").alias("_n"), F.sum(row_bytes(source.schema)).alias("_bytes")
    )
    rows, size, most = per_key.agg(
        F.sum("_n"), F.sum("_bytes"), F.max(F.when(has_key, F.col("_n")))
    ).first()
    return within_limits(rows or 0, size or 0), (most or 0) > 1


def _one_match_each(labelled: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row per target row (_target), with the clause that acts on it if any does."""
    acting = labelled.groupBy("_target").agg(F.count("_clause").alias("_n"))
    if not acting.filter("_n > 1").isEmpty():
        raise DuplicateKeys(f"several source rows change one target row, by {list(on)}")
    order = Window.partitionBy("_target").orderBy(F.col("_clause").asc_nulls_last())
    return labelled.withColumn("_place", F.row_number().over(order)).filter("_place = 1")


def merge_actions(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    clauses: Sequence[Clause],
    dedupe_by: Sequence[str] = (),
) -> DataFrame:
    """The target's columns plus ``merge_action``: keep, update, delete or insert.

    The first clause whose condition is true acts. A matched row without one stays,
    an unmatched source row without one is ignored. Null keys match nothing. Source keys
    may repeat, but two source rows that change the same target row raise; all unmatched
    rows are inserted. ``dedupe_by`` takes the latest source row of a key, among those for
    matched clauses and among those for insertions. Both sides are read more than once,
    so they must not change in between.

    A source measured to be small is broadcast, and the target is not shuffled. A
    large one is joined by shuffle: the left join can split a key that many target
    rows share, and only distinct target keys go into the anti join.
    """
    matched = [clause for clause in clauses if clause.matched]
    inserts = [clause for clause in clauses if not clause.matched]

    def side(chosen: Sequence[Clause]) -> DataFrame:
        rows = _acting_rows(source, chosen) if chosen else source.limit(0)
        return _latest_per_key(rows, on, dedupe_by) if dedupe_by else rows

    changing, inserted = side(matched), side(inserts)
    is_small, repeats = _measure(changing, on)
    t, s = target.alias("t"), changing.withColumn("_hit", F.lit(True)).alias("s")
    if repeats:
        t = target.withColumn("_target", F.monotonically_increasing_id()).alias("t")
    if is_small:
        s = F.broadcast(s)
    same_key = reduce(and_, [F.col(f"t.{name}") == F.col(f"s.{name}") for name in on])

    labelled = t.join(s, same_key, "left").withColumn(
        "_clause", _first_true(matched, F.col("s._hit"))
    )
    if repeats:
        labelled = _one_match_each(labelled, on)
    action, columns = F.lit("keep"), []
    for number, clause in enumerate(matched):
        action = F.when(F.col("_clause") == number, F.lit(clause.action)).otherwise(action)
    for item in target.schema:
        value = F.col(f"t.{item.name}")
        for number, clause in enumerate(matched):
            if item.name in clause.values:
                new = F.expr(clause.values[item.name]).cast(item.dataType)
                value = F.when(F.col("_clause") == number, new).otherwise(value)
        columns.append(value.alias(item.name))
    changed = labelled.select(*columns, action.alias("merge_action"))

    if not inserts:
        return changed
    # Distinct before any shuffle join, so that a key that fills much of the target is
    # one row per task; a small source first narrows them down to the keys it names.
    # Keys in a row shrink to a byte or two when shuffled, so that millions of them would
    # be put into one task; a hash that does not shrink goes with each.
    hit = target.select(*on)
    if _measure(inserted, on)[0]:
        hit = hit.join(F.broadcast(inserted.select(*on)), list(on), "left_semi")
    hit = hit.groupBy(*on).agg(F.min(F.xxhash64(*on)).alias("_hash"))
    hit = hit.filter(F.col("_hash").isNotNull()).drop("_hash")
    candidates = (
        inserted.join(hit, list(on), "left_anti")
        .select(*source.columns)
        .alias("s")
        .withColumn("_clause", _first_true(inserts, F.lit(True)))
        .filter("_clause is not null")
    )
    columns = []
    for item in target.schema:
        value = F.lit(None)
        for number, clause in enumerate(inserts):
            given = clause.values or {name: f"s.`{name}`" for name in source.columns}
            if item.name in given:
                new = F.expr(given[item.name]).cast(item.dataType)
                value = F.when(F.col("_clause") == number, new).otherwise(value)
        columns.append(value.cast(item.dataType).alias(item.name))
    return changed.unionByName(
        candidates.select(*columns, F.lit("insert").alias("merge_action"))
    )


def _first_true(clauses: Sequence[Clause], applies: Column) -> Column:
    """Number of the first clause whose condition is true, else null."""
    number = F.lit(None).cast("int")
    for index, clause in reversed(list(enumerate(clauses))):
        condition = applies
        if clause.condition is not None:
            condition = applies & F.expr(clause.condition)
        number = F.when(condition, F.lit(index)).otherwise(number)
    return number


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    clauses: Sequence[Clause],
    dedupe_by: Sequence[str] = (),
) -> DataFrame:
    """The target after the merge."""
    actions = merge_actions(target, source, on, clauses, dedupe_by)
    return actions.filter("merge_action <> 'delete'").drop("merge_action")


_METRICS = {
    "num_updated_rows": "update",
    "num_deleted_rows": "delete",
    "num_inserted_rows": "insert",
}


def _metric_columns() -> list[Column]:
    changed = F.count_if(F.col("merge_action") != "keep").alias("num_affected_rows")
    return [changed] + [
        F.count_if(F.col("merge_action") == action).alias(name)
        for name, action in _METRICS.items()
    ]


def merge_metrics(actions: DataFrame) -> DataFrame:
    """Rows affected, updated, deleted and inserted, from merge_actions()."""
    return actions.agg(*_metric_columns())


def write_merge(actions: DataFrame, path: str) -> dict[str, int]:
    """Write the merged table to a new path; the metrics come from the same pass."""
    seen = Observation("merge")
    observed = actions.observe(seen, *_metric_columns())
    write_layer(observed.filter("merge_action <> 'delete'").drop("merge_action"), path)
    return dict(seen.get)
