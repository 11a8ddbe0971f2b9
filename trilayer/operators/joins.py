"""Joins with small tables, broadcast only after measuring them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_ROWS = 1_000_000
MAX_BYTES = 64 * 1024 * 1024


def row_bytes(schema: T.StructType) -> Column:
    """About how many bytes a row takes in memory."""
    width = F.lit(0)
    for item in schema:
        size = F.lit(0)
        if isinstance(item.dataType, (T.StringType, T.BinaryType)):
            size = F.octet_length(item.name)
        elif isinstance(item.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = F.octet_length(F.to_json(item.name))
        width = width + F.coalesce(size, F.lit(0)) + 16
    return width.cast("long")


def within_limits(
    rows: int, size: int, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES
) -> bool:
    return rows <= max_rows and size <= max_bytes


def fits_broadcast(
    df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES
) -> bool:
    """Whether ``df`` is small, by counting all of its rows and bytes."""
    rows, size = df.agg(F.count("*"), F.sum(row_bytes(df.schema))).first()
    return within_limits(rows, size or 0, max_rows, max_bytes)


def broadcast_if_small(
    df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES
) -> DataFrame:
    """``df`` with a broadcast hint if it is measured to be small, else as it is.

    Without the hint the join is left to the optimizer, which shuffles both sides
    and splits skewed partitions at run time.
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def attach_daily_total(
    trips: DataFrame,
    daily: DataFrame,
    output: str = "total_trips_on_pickup_day",
    hint: str | None = None,
    time: str = "tpep_pickup_datetime",
) -> DataFrame:
    """Each trip with the number of trips on its day.

    ``hint`` may name a join strategy (``merge``, ``shuffle_hash``); ``broadcast``
    is applied only if ``daily`` is measured to be small.
    """
    if hint == "broadcast":
        daily = broadcast_if_small(daily)
    elif hint:
        daily = daily.hint(hint)
    joined = trips.join(daily, F.date_trunc("day", trips[time]) == daily["trip_date"])
    return joined.select(
        *[trips[name] for name in trips.columns], daily["total_trips"].alias(output)
    )


def attach_daily_total_sql(
    trips: DataFrame, daily: DataFrame, output: str = "total_trips_on_pickup_day"
) -> DataFrame:
    """The same as a SQL statement with a SQL hint."""
    hint = "/*+ BROADCAST(d) */" if fits_broadcast(daily) else ""
    return trips.sparkSession.sql(
        f"""
        SELECT {hint} t.*, d.total_trips AS {output}
        FROM {{trips}} t JOIN {{daily}} d
          ON date_trunc('DAY', t.tpep_pickup_datetime) = d.trip_date
        """,
        trips=trips,
        daily=daily,
    )


def lookup_names(
    df: DataFrame, lookup: DataFrame, keys: Mapping[str, str], names: Mapping[str, str]
) -> DataFrame:
    """Add columns of a lookup table; rows without a match keep null names.

    ``keys`` maps columns of ``df`` to key columns of ``lookup``, ``names`` maps
    lookup columns to the names they get.
    """
    small = broadcast_if_small(
        lookup.select(
            *[F.col(key).alias(f"_key_{key}") for key in keys.values()],
            *[F.col(name).alias(new) for name, new in names.items()],
        )
    )
    condition = [F.col(mine) == F.col(f"_key_{theirs}") for mine, theirs in keys.items()]
    return df.join(small, condition, "left").select(*df.columns, *names.values())
