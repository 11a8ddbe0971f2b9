"""The two chained trip streams: ingestion, then windowed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilayer.sources.raw import add_ingest_metadata

PICKUP = "tpep_pickup_datetime"


def with_stream_metadata(files: DataFrame) -> DataFrame:
    """Processing time and source file of each streamed row."""
    return add_ingest_metadata(
        files, "streaming_ingestion_timestamp", "streaming_source_file"
    )


def bronze_stream(trips: DataFrame) -> DataFrame:
    """Event times as timestamps, one conformed name."""
    times = [name for name in (PICKUP, "tpep_dropoff_datetime") if name in trips.columns]
    return trips.withColumns(
        {name: F.col(name).cast("timestamp") for name in times}
    ).withColumnRenamed("PULocationID", "pickup_location_id")


def window_counts(
    trips: DataFrame,
    time: str = PICKUP,
    key: str = "pickup_location_id",
    width: str = "10 minutes",
    delay: str = "20 minutes",
) -> DataFrame:
    """Trips per tumbling window and key; windows close ``delay`` behind the newest."""
    return (
        trips.withWatermark(time, delay)
        .groupBy(F.window(time, width), key)
        .agg(F.count("*").alias("trip_count"))
    )


def read_updates(
    spark: SparkSession, path: str, key: str = "pickup_location_id"
) -> DataFrame:
    """The newest count of each window from an update-mode sink."""
    return (
        spark.read.parquet(path)
        .groupBy("window", key)
        .agg(F.max_by("trip_count", "batch_id").alias("trip_count"))
    )


def flat_windows(counts: DataFrame) -> DataFrame:
    """Window bounds as two columns."""
    return counts.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *[name for name in counts.columns if name != "window"],
    )
