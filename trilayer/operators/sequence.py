"""The next value along a key's timeline, also for keys too big for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trilayer.operators.joins import broadcast_if_small
from trilayer.workspace import written

# Rows of one group that one task sorts without trouble.
HOT_ROWS = 1_000_000
# Slices cut per HOT_ROWS rows, so that uneven spread over time mostly leaves slices
# under HOT_ROWS at the first cut.
OVERSPLIT = 8
# Rows without a time need no order; they are spread over this many groups per key.
SPREAD = 4096


def add_next_time(
    df: DataFrame,
    key: str,
    time: str,
    tie: str,
    output: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``output`` = the ``time`` of the key's next row by (time, tie), else null.

    ``tie`` is a unique whole number. Rows without a time get null.

    Usually this is one window over ``key``. If some key has more than ``hot_rows``
    rows, its timeline is cut into slices, each sorted by a task of its own. A marker
    row at the end of each slice carries the first time of the following slice, so
    the last row of a slice finds its successor in the same window. A slice that is
    still too large, as after a burst, is cut again by its own bounds. Each cut is
    written, so neither the plan nor what it reads grows with the number of cuts.
    """
    has_time = F.col(time).isNotNull()
    groups, parts = [key], df
    while True:
        hot = written(hot_groups(parts, groups, time, tie, hot_rows), "hot-groups")
        if hot.isEmpty():
            break
        parts = _cut(parts, hot, groups, time, tie)
        groups = [*groups, f"_slice{len(groups)}"]
    order = [time, tie] if parts is df else [time, "_marker", tie]
    spread = F.when(~has_time, F.pmod(F.col(tie), F.lit(SPREAD)))
    chunk = Window.partitionBy(*groups, spread).orderBy(*order)
    found = parts.withColumn(output, F.when(has_time, F.lead(time).over(chunk)))
    if parts is not df:
        found = found.filter(~F.col("_marker"))
    return found.select(*df.columns, output)


def _micros(time: str) -> Column:
    return F.unix_micros(F.col(time).cast("timestamp"))


def hot_groups(
    df: DataFrame, groups: Sequence[str], time: str, tie: str, hot_rows: int
) -> DataFrame:
    """Groups with more than ``hot_rows`` timed rows, and how to slice each.

    There can be at most (rows of df / hot_rows) of them. Null counts as a key. A
    group is sliced by time, or by ``tie`` if all its rows have the same time.
    """
    rows = df.filter(F.col(time).isNotNull())
    if "_marker" in df.columns:
        rows = rows.filter(~F.col("_marker"))
    spans = rows.groupBy(*groups).agg(
        F.count("*").alias("_n"),
        F.min(_micros(time)).alias("_lo_time"),
        F.max(_micros(time)).alias("_hi_time"),
        F.min(tie).alias("_lo_tie"),
        F.max(tie).alias("_hi_tie"),
    )
    by_tie = F.col("_lo_time") == F.col("_hi_time")
    low = F.when(by_tie, F.col("_lo_tie")).otherwise(F.col("_lo_time"))
    high = F.when(by_tie, F.col("_hi_tie")).otherwise(F.col("_hi_time"))
    slices = F.ceil(F.col("_n") / hot_rows) * OVERSPLIT
    return spans.filter((F.col("_n") > hot_rows) & (high > low)).select(
        *[F.col(name).alias(f"_hot{name}") for name in groups],
        by_tie.alias("_by_tie"),
        low.alias("_low"),
        high.alias("_high"),
        F.ceil((high - low + 1) / slices).alias("_width"),
    )


def _cut(
    df: DataFrame, hot: DataFrame, groups: Sequence[str], time: str, tie: str
) -> DataFrame:
    """The rows with the slice each belongs to, and a marker at the end of each slice.

    Groups that are not hot have no slice. Markers from an earlier cut are later than
    all rows of their group and go into its last slice.
    """
    output = f"_slice{len(groups)}"
    if "_marker" not in df.columns:
        df = df.withColumn("_marker", F.lit(False))
    same = [F.col(name).eqNullSafe(F.col(f"_hot{name}")) for name in groups]
    place = F.when(F.col("_by_tie"), F.col(tie)).otherwise(_micros(time))
    place = F.when(F.col("_marker"), F.col("_high")).otherwise(place)
    sliced = written(
        df.join(broadcast_if_small(hot), same, "left")
        .withColumn("_place", place)
        .withColumn(output, F.expr("(_place - _low) div _width"))
        .select(*df.columns, output),
        "sliced",
    )
    # At most OVERSPLIT * (rows of the group / hot_rows + 1) rows per group from here on.
    timeline = Window.partitionBy(*groups).orderBy(output)
    markers = (
        sliced.filter(F.col(output).isNotNull())
        .groupBy(*groups, output)
        .agg(F.min(time).alias("_first"))
        .withColumn(time, F.lead("_first").over(timeline))
        .filter(F.col(time).isNotNull())
        .select(*groups, output, time, F.lit(True).alias("_marker"))
    )
    return sliced.unionByName(markers, allowMissingColumns=True)
