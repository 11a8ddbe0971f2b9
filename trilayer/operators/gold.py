"""Aggregates over the silver layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trilayer.functions.exact import exact_avg, round2, rounded_sum
from trilayer.functions.times import partition_columns


def day(time: str = "tpep_pickup_datetime") -> Column:
    return F.date_trunc("day", time)


def daily_summary(silver: DataFrame, time: str = "tpep_pickup_datetime") -> DataFrame:
    return silver.groupBy(day(time).alias("trip_date")).agg(
        F.count("*").alias("total_trips"),
        round2(exact_avg("trip_distance")).alias("average_trip_distance_miles"),
        rounded_sum("fare_amount").alias("total_fare_amount"),
        rounded_sum("tip_amount").alias("total_tip_amount"),
        round2(exact_avg("trip_duration_minutes")).alias("average_trip_duration_minutes"),
    )


def zone_summary(silver: DataFrame, zone: str = "pickup_location_id") -> DataFrame:
    """Per zone, and per year and month where the table has them."""
    return silver.groupBy(*partition_columns(silver), zone).agg(
        F.count("*").alias("total_trips"),
        round2(exact_avg("total_amount")).alias("average_total_amount"),
        round2(exact_avg("tip_amount")).alias("average_tip_amount"),
        round2(exact_avg("trip_distance")).alias("average_trip_distance_miles"),
        F.count_distinct("vendor_id").alias("distinct_vendors_count"),
    )


def zone_order(summary: DataFrame, zone: str = "pickup_location_id") -> DataFrame:
    """Busiest zones first within each year and month."""
    return summary.orderBy(
        *partition_columns(summary), F.col("total_trips").desc(), zone
    )


def revenue_summary(silver: DataFrame, time: str = "tpep_pickup_datetime") -> DataFrame:
    return silver.groupBy(day(time).alias("trip_date")).agg(
        F.count("*").alias("total_trips"),
        round2(exact_avg("trip_distance")).alias("average_trip_distance"),
        rounded_sum("total_amount").alias("total_revenue"),
    )


def average_per(df: DataFrame, keys: Sequence[str], value: str, output: str) -> DataFrame:
    return df.groupBy(*keys).agg(exact_avg(value).alias(output))


def rows_per(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).count()


def first_rows(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows in a stated order; end the order with a unique column."""
    return df.orderBy(*order).limit(n)
