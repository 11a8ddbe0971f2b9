"""Raw rows to typed, valid, enriched rows."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trilayer.functions.exact import round2
from trilayer.functions.times import seconds_between


@dataclass(frozen=True)
class CleanseSpec:
    """What cleansing means for one kind of record.

    ``rules`` maps a rule name to a SQL condition over the filled, not yet renamed
    columns. A row stays if every condition is true; unknown counts as not true.
    """

    drop: tuple[str, ...] = ()
    casts: Mapping[str, str] = field(default_factory=dict)
    fills: Mapping[str, int | float | str] = field(default_factory=dict)
    rules: Mapping[str, str] = field(default_factory=dict)
    renames: Mapping[str, str] = field(default_factory=dict)


_SECONDS = "unix_timestamp(tpep_dropoff_datetime) - unix_timestamp(tpep_pickup_datetime)"

# Column types, defaults, limits and names of the silver trip table.
TRIPS = CleanseSpec(
    drop=("source_file", "ingestion_timestamp"),
    casts={
        "tpep_pickup_datetime": "timestamp",
        "tpep_dropoff_datetime": "timestamp",
        "passenger_count": "int",
        "trip_distance": "double",
        "RatecodeID": "int",
        "PULocationID": "int",
        "DOLocationID": "int",
        "fare_amount": "double",
        "extra": "double",
        "mta_tax": "double",
        "tip_amount": "double",
        "tolls_amount": "double",
        "improvement_surcharge": "double",
        "total_amount": "double",
        "congestion_surcharge": "double",
        "airport_fee": "double",
        "VendorID": "int",
    },
    fills={
        "passenger_count": 1,
        "tip_amount": 0.0,
        "RatecodeID": 99,
        "congestion_surcharge": 0.0,
        "airport_fee": 0.0,
    },
    rules={
        "distance_not_negative": "trip_distance >= 0",
        "fare_not_negative": "fare_amount >= 0",
        "total_not_negative": "total_amount >= 0",
        "has_passengers": "passenger_count > 0",
        "pickup_before_dropoff": "tpep_pickup_datetime <= tpep_dropoff_datetime",
        "longer_than_10_seconds": f"{_SECONDS} > 10",
        "shorter_than_24_hours": f"{_SECONDS} < 86400",
    },
    renames={
        "VendorID": "vendor_id",
        "RatecodeID": "rate_code_id",
        "PULocationID": "pickup_location_id",
        "DOLocationID": "dropoff_location_id",
    },
)


def cast_columns(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Cast in one projection. Text that does not parse becomes null."""
    kinds = dict(df.dtypes)

    def cast(name: str) -> Column:
        column = F.col(name)
        if name not in casts:
            return column
        if kinds[name] == "string":
            return column.try_cast(casts[name]).alias(name)
        return column.cast(casts[name]).alias(name)

    return df.select(*[cast(name) for name in df.columns])


def fill_defaults(df: DataFrame, fills: Mapping[str, int | float | str]) -> DataFrame:
    return df.na.fill(dict(fills))


def holds(condition: str) -> Column:
    """The condition as true or false; unknown is false."""
    return F.coalesce(F.expr(condition), F.lit(False))


def valid_rows(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    for condition in rules.values():
        df = df.filter(condition)
    return df


def conform(df: DataFrame, spec: CleanseSpec) -> DataFrame:
    """Drop, cast and fill: the rows that the rules are about."""
    casts = {name: kind for name, kind in spec.casts.items() if name in df.columns}
    return fill_defaults(cast_columns(df.drop(*spec.drop), casts), spec.fills)


def cleanse(df: DataFrame, spec: CleanseSpec = TRIPS) -> DataFrame:
    kept = valid_rows(conform(df, spec), spec.rules)
    return kept.withColumnsRenamed(dict(spec.renames))


def rejects(df: DataFrame, spec: CleanseSpec = TRIPS) -> DataFrame:
    """The rows that cleansing drops, each with the names of the rules it breaks."""
    failed = F.array_compact(
        F.array(*[F.when(~holds(c), F.lit(name)) for name, c in spec.rules.items()])
    )
    return conform(df, spec).withColumn("failed_rules", failed).filter(
        F.size("failed_rules") > 0
    )


def reject_counts(df: DataFrame, spec: CleanseSpec = TRIPS) -> DataFrame:
    """Rows that break each rule, in one pass; a row may break several."""
    counts = conform(df, spec).agg(
        *[F.count_if(~holds(c)).alias(name) for name, c in spec.rules.items()]
    )
    return counts.unpivot([], list(spec.rules), "rule", "rejected_rows")


def layer_counts(df: DataFrame, spec: CleanseSpec = TRIPS) -> DataFrame:
    """Rows before and after cleansing, in one pass."""
    every_rule = F.lit(True)
    for condition in spec.rules.values():
        every_rule = every_rule & holds(condition)
    return conform(df, spec).agg(
        F.count("*").alias("bronze_rows"), F.count_if(every_rule).alias("silver_rows")
    )


def enrich(
    df: DataFrame,
    start: str = "tpep_pickup_datetime",
    end: str = "tpep_dropoff_datetime",
    distance: str = "trip_distance",
) -> DataFrame:
    """Duration in seconds and minutes, and miles per hour."""
    seconds = F.col("trip_duration_seconds")
    speed = F.when(seconds > 0, round2(F.col(distance) / (seconds / 3600)))
    return (
        df.withColumn("trip_duration_seconds", seconds_between(start, end))
        .withColumn("trip_duration_minutes", round2(seconds / 60))
        .withColumn("average_speed_mph", speed.otherwise(0.0))
    )


def silver(df: DataFrame, spec: CleanseSpec = TRIPS) -> DataFrame:
    return enrich(cleanse(df, spec))
