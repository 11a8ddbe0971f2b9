"""History, as-of reads and reverts over a change log.

A change log has one row per changed key and version: key and value columns,
``version``, ``commit_ts``, ``op`` (INSERT, UPDATE or DELETE) and ``operation``
(the name of the commit). Several changes of a key within one version need a
further ordering column, named in ``order_by``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def change_history(log: DataFrame) -> DataFrame:
    """One row per version, with its time, operation and changed rows."""
    return log.groupBy("version", "commit_ts", "operation").agg(
        F.count_if(F.col("op") == "INSERT").alias("rows_inserted"),
        F.count_if(F.col("op") == "UPDATE").alias("rows_updated"),
        F.count_if(F.col("op") == "DELETE").alias("rows_deleted"),
    )


def state_as_of(
    log: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    version: int | None = None,
    timestamp: str | None = None,
    order_by: Sequence[str] = ("version",),
) -> DataFrame:
    """The rows as they stood at a version, or at a time (latest commit up to it).

    The latest change per key is an aggregate, not a window: each task first reduces
    its own rows, so a key with many changes is never gathered in one place.
    """
    if version is not None:
        log = log.filter(F.col("version") <= version)
    if timestamp is not None:
        log = log.filter(F.col("commit_ts") <= F.lit(timestamp).cast("timestamp_ntz"))
    last = F.max_by(F.struct("op", *values), F.struct(*order_by))
    return (
        log.groupBy(*keys)
        .agg(last.alias("_last"))
        .filter("_last.op <> 'DELETE'")
        .select(*keys, *[F.col(f"_last.{name}").alias(name) for name in values])
    )


def version_before(log: DataFrame, operation: str = "MERGE", write: str = "WRITE") -> DataFrame:
    """One row: latest version, latest ``write`` before it, and the version before
    the first ``operation``. Null where there is no such version."""
    commits = log.select("version", "operation")
    latest = commits.select(F.max("version")).scalar()
    is_prior_write = (F.col("operation") == write) & (F.col("version") < latest)
    first = F.min(F.when(F.col("operation") == operation, F.col("version")))
    return commits.agg(
        F.max("version").alias("latest_version"),
        F.max(F.when(is_prior_write, F.col("version"))).alias("prior_write_version"),
        (first - 1).alias(f"version_before_{operation.lower()}"),
    )


def revert_changes(
    log: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    version: int | None = None,
    commit_ts: Column | None = None,
    order_by: Sequence[str] = ("version",),
    timestamp: str | None = None,
) -> DataFrame:
    """The changes that make the state at ``version``, or at ``timestamp``, current again,
    as a new version committed at ``commit_ts`` (now, if not given).

    Both states come from one grouping of the log. Appending the result to the log
    restores the old state and keeps all history.
    """
    if (version is None) == (timestamp is None):
        raise ValueError("give a version or a timestamp")
    if commit_ts is None:
        commit_ts = F.current_timestamp().cast("timestamp_ntz")
    order = F.struct(*order_by)
    change = F.struct("op", *values)
    if version is not None:
        is_old = F.col("version") <= version
    else:
        is_old = F.col("commit_ts") <= F.lit(timestamp).cast("timestamp_ntz")
    old_order = F.when(is_old, order)
    pairs = log.groupBy(*keys).agg(
        F.max_by(change, order).alias("now"), F.max_by(change, old_order).alias("old")
    )
    is_live = F.coalesce(F.col("now.op") != "DELETE", F.lit(False))
    was_live = F.coalesce(F.col("old.op") != "DELETE", F.lit(False))
    same = F.lit(True)
    for name in values:
        same = same & F.col(f"now.{name}").eqNullSafe(F.col(f"old.{name}"))
    op = (
        F.when(was_live & ~is_live, "INSERT")
        .when(~was_live & is_live, "DELETE")
        .when(was_live & is_live & ~same, "UPDATE")
    )
    restored = [
        F.when(was_live, F.col(f"old.{name}")).otherwise(F.col(f"now.{name}")).alias(name)
        for name in values
    ]
    next_version = log.select(F.max("version") + 1).scalar()
    return pairs.withColumn("_op", op).filter("_op is not null").select(
        *keys,
        *restored,
        next_version.cast("long").alias("version"),
        commit_ts.alias("commit_ts"),
        F.col("_op").alias("op"),
        F.lit("RESTORE").alias("operation"),
    )
