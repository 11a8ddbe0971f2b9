"""Do two tables hold the same rows?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trilayer.sources.raw import read_raw
from trilayer.sources.writers import write_layer


def reconcile(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: row counts of both sides, and whether counts and contents agree.

    Contents are compared by two sums of 64-bit row hashes, which do not depend on
    the order of rows and count duplicates. A hash leaves nulls out, so each column goes
    in with whether it is null. Columns that differ in name or type raise.
    """
    if sorted(left.dtypes) != sorted(right.dtypes):
        raise ValueError("the two sides have different columns")

    def hashed(df: DataFrame, side: str) -> DataFrame:
        columns = [
            part for name in sorted(df.columns) for part in (F.isnull(name), F.col(name))
        ]
        return df.select(
            F.lit(side).alias("side"),
            F.xxhash64(*columns).cast("decimal(38,0)").alias("h1"),
            F.xxhash64(F.lit("second"), *columns).cast("decimal(38,0)").alias("h2"),
        )

    sides = (
        hashed(left, "left")
        .union(hashed(right, "right"))
        .groupBy("side")
        .agg(
            F.count("*").alias("n"), F.sum("h1").alias("h1"), F.sum("h2").alias("h2")
        )
    )

    def of(side: str, name: str):
        return F.max(F.when(F.col("side") == side, F.col(name)))

    same = of("left", "h1").eqNullSafe(of("right", "h1")) & of("left", "h2").eqNullSafe(
        of("right", "h2")
    )
    left_rows = F.coalesce(of("left", "n"), F.lit(0))
    right_rows = F.coalesce(of("right", "n"), F.lit(0))
    return sides.agg(
        left_rows.alias("left_rows"),
        right_rows.alias("right_rows"),
        (left_rows == right_rows).alias("counts_equal"),
        ((left_rows == right_rows) & same).alias("contents_equal"),
    )


def copy_verified(source: DataFrame, path: str) -> DataFrame:
    """Write an independent copy, compare it with the source, return it.

    Raises if the copy differs.
    """
    write_layer(source, path)
    copy = read_raw(source.sparkSession, path)
    verdict = reconcile(source, copy).first()
    if not verdict["contents_equal"]:
        raise RuntimeError(f"copy differs from its source: {verdict.asDict()}")
    return copy
