"""Event-time columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def add_time_partitions(
    df: DataFrame, event_time: str = "tpep_pickup_datetime", prefix: str = "pickup"
) -> DataFrame:
    """``<prefix>_year`` and ``<prefix>_month``, if the event time is there at all."""
    if event_time not in df.columns:
        return df
    return df.withColumns(
        {f"{prefix}_year": F.year(event_time), f"{prefix}_month": F.month(event_time)}
    )


def partition_columns(df: DataFrame, prefix: str = "pickup") -> list[str]:
    """The time partition columns that ``df`` has, all of them or none."""
    wanted = [f"{prefix}_year", f"{prefix}_month"]
    return wanted if set(wanted) <= set(df.columns) else []


def seconds_between(start: str, end: str) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def without_zone(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock values, so readers need not know the session zone."""
    zoned = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})
