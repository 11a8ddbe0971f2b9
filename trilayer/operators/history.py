"""A change log as validity intervals, so that any state is one filter.

Each interval has the key and value columns, ``since`` and ``since_ts`` (the commit that
brought the row about) and ``until`` and ``until_ts`` (the one that ended it, OPEN and null
while there is none). On disk the intervals are partitioned by ``until`` and, while open,
by a hash of the key (``part``). Ended intervals are never written again; a commit reads and
rewrites only the open parts that hold its keys, and a state as of a version skips all
partitions that had ended by then.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trilayer.operators.joins import broadcast_if_small
from trilayer.operators.ranged import RANGE_ROWS, next_row
from trilayer.sources.raw import read_raw
from trilayer.sources.writers import write_layer
from trilayer.workspace import written

#: ``until`` of an interval that has not ended.
OPEN = (1 << 63) - 1
PARTS = 64
TIMES = ["since", "since_ts", "until", "until_ts"]


def intervals(
    log: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    order_by: Sequence[str] = ("version",),
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """The intervals of a change log as described in operators.versions.

    Of several changes of a key within one version, told apart by ``order_by``, only the
    last has an interval. A key with very many changes is cut into ranges.
    """
    changes = log.select(
        *keys, *values, "version", "commit_ts", "op", *[o for o in order_by if o != "version"],
        F.struct("version", "commit_ts").alias("_commit"),
    )
    found = next_row(changes, keys, order_by, "_commit", "_ended", range_rows)
    until = F.coalesce(F.col("_ended.version").cast("long"), F.lit(OPEN))
    return found.filter((F.col("op") != "DELETE") & (until > F.col("version"))).select(
        *keys, *values,
        F.col("version").cast("long").alias("since"), F.col("commit_ts").alias("since_ts"),
        until.alias("until"), F.col("_ended.commit_ts").alias("until_ts"),
    )


def as_of(history: DataFrame, version: int | None = None, timestamp: str | None = None) -> DataFrame:
    """The rows as they stood at a version, or at a time."""
    if (version is None) == (timestamp is None):
        raise ValueError("give a version or a timestamp")
    if version is not None:
        held = history.filter((F.col("since") <= version) & (F.col("until") > version))
    else:
        moment = F.lit(timestamp).cast("timestamp_ntz")
        ended = F.coalesce(F.col("until_ts") <= moment, F.lit(False))
        held = history.filter((F.col("since_ts") <= moment) & ~ended)
    return held.drop(*TIMES, "part")


def _part(keys: Sequence[str], parts: int, until: Column) -> Column:
    hashed = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")
    return F.when(until == OPEN, hashed).otherwise(F.lit(-1))


def write_history(
    found: DataFrame, path: str, keys: Sequence[str], parts: int = PARTS
) -> T.StructType:
    """Write intervals as a new history; returns its schema, by which it is read."""
    rows = found.withColumn("part", _part(keys, parts, F.col("until")))
    write_layer(rows, path, partition_by=["until", "part"], rebalance=True)
    return rows.schema


def read_history(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_raw(spark, path, schema=schema)


def commit(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    values: Sequence[str],
    changes: DataFrame,
    version: int,
    commit_ts: str,
    parts: int = PARTS,
) -> None:
    """Bring the changes of one version into a history: one row per key, with its ``op``.

    The intervals that end are written first, under their version; then the open parts that
    hold changed keys are replaced. Either step can be repeated after a failure, and so can
    the whole commit. ``parts`` is that of write_history().
    """
    moment = F.lit(commit_ts).cast(schema["since_ts"].dataType)
    changes = written(
        changes.select(*keys, *values, "op").withColumn("part", _part(keys, parts, F.lit(OPEN))),
        "history-changes",
    )
    touched = [r[0] for r in changes.select("part").distinct().collect()]  # at most ``parts``
    rows = read_history(spark, path, schema).filter(
        (F.col("until") == OPEN) & F.col("part").isin(touched) & (F.col("since") < version)
    )
    before = written(rows, "history-open")
    same = [F.col(f"o.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
    keyed = broadcast_if_small(changes.select(*keys)).alias("c")
    ended = before.alias("o").join(keyed, same, "left_semi").withColumns(
        {"until": F.lit(version).cast("long"), "until_ts": moment, "part": F.lit(-1)}
    )
    partition = {"partition_by": ["until", "part"], "replace_only_written_partitions": True}
    write_layer(ended.select(*schema.names), path, **partition)
    stays = before.alias("o").join(keyed, same, "left_anti")
    opened = changes.filter("op <> 'DELETE'").select(
        *keys, *values, F.lit(version).cast("long").alias("since"), moment.alias("since_ts"),
        F.lit(OPEN).alias("until"), F.lit(None).cast(schema["until_ts"].dataType).alias("until_ts"),
        "part",
    )
    emptied = before.select("part").distinct().join(
        stays.select("part").unionByName(opened.select("part")).distinct(), "part", "left_anti"
    )
    remains = stays.select(*schema.names).unionByName(opened.select(*schema.names))
    write_layer(remains, path, rebalance=True, **partition)
    _clear(spark, path, [r[0] for r in emptied.collect()])


def _clear(spark: SparkSession, path: str, parts: Sequence[int]) -> None:
    """Delete open parts that no row is left in; writing nothing would not replace them."""
    for part in parts:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/until={OPEN}/part={part}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
