"""Bronze, silver and gold as named datasets under row rules.

The rules here differ from those of the batch layers on purpose: a negative fare is
kept and counted, a missing passenger count is filled while selecting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trilayer.functions.exact import round2
from trilayer.functions.times import add_time_partitions, seconds_between
from trilayer.operators.gold import revenue_summary
from trilayer.operators.quality import Rule, apply_rules

# Rule names, conditions and actions of the declared silver dataset.
RULES = (
    Rule("valid_trip_distance", "trip_distance >= 0", "drop"),
    Rule("valid_fare", "fare_amount >= 0", "warn"),
    Rule("valid_pickup_time", "tpep_pickup_datetime IS NOT NULL", "fail"),
    Rule("plausible_duration", "trip_duration_minutes < 1440", "warn"),
)
# The stricter set, where an implausible duration stops the update as well.
STRICT_RULES = (*RULES[:3], Rule("plausible_duration", RULES[3].condition, "fail"))

IN_TIME_ORDER = "tpep_pickup_datetime <= tpep_dropoff_datetime"


def shape_silver(bronze: DataFrame) -> DataFrame:
    """The silver columns; rows are neither filtered nor checked."""
    carried = [
        name
        for name in ("event_id", "ingestion_timestamp", "source_file")
        if name in bronze.columns
    ]
    minutes = seconds_between("tpep_pickup_datetime", "tpep_dropoff_datetime") / 60
    shaped = bronze.select(
        F.col("VendorID").cast("int").alias("vendor_id"),
        F.col("tpep_pickup_datetime").cast("timestamp").alias("tpep_pickup_datetime"),
        F.col("tpep_dropoff_datetime").cast("timestamp").alias("tpep_dropoff_datetime"),
        F.coalesce(F.col("passenger_count").cast("int"), F.lit(1)).alias("passenger_count"),
        F.col("trip_distance").cast("double").alias("trip_distance"),
        F.col("PULocationID").alias("pickup_location_id"),
        F.col("DOLocationID").alias("dropoff_location_id"),
        F.col("fare_amount").cast("double").alias("fare_amount"),
        F.coalesce(F.col("tip_amount").cast("double"), F.lit(0.0)).alias("tip_amount"),
        F.col("total_amount").cast("double").alias("total_amount"),
        round2(minutes).alias("trip_duration_minutes"),
        *carried,
    )
    return add_time_partitions(shaped)


def declared_silver(bronze: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    return apply_rules(shape_silver(bronze).filter(IN_TIME_ORDER), rules)


def declared_gold(silver: DataFrame) -> DataFrame:
    return revenue_summary(silver)
