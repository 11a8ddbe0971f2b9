"""Trip records derived from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilayer.operators.sequence import HOT_ROWS, add_next_time
from trilayer.sources.raw import add_ingest_metadata, table


def parse_events(events: DataFrame) -> DataFrame:
    """Events with the number in ``props`` as ``k``, so that no shuffle carries JSON."""
    k = F.get_json_object("props", "$.k").cast("int")
    return events.withColumn("k", k).drop("props")


def shape_trips(events: DataFrame) -> DataFrame:
    """Raw trip columns from parsed events; drop-off is ``next_ts`` where present.

    Columns that events do not have by themselves, such as metadata, are carried on.
    """
    k = F.col("k")
    tip = F.when(F.col("event_type") == "purchase", F.col("value") * 0.25)
    dropoff = [F.col("next_ts").alias("tpep_dropoff_datetime")]
    own = {"event_id", "ts", "user_id", "event_type", "value", "k", "next_ts"}
    return events.select(
        "event_id",
        F.length("event_type").alias("VendorID"),
        F.col("ts").alias("tpep_pickup_datetime"),
        *(dropoff if "next_ts" in events.columns else []),
        F.nullif(k % 7, F.lit(6)).alias("passenger_count"),
        (F.col("value") - 1.0).alias("trip_distance"),
        F.nullif(k % 5, F.lit(0)).alias("RatecodeID"),
        F.lit("N").alias("store_and_fwd_flag"),
        F.col("user_id").alias("PULocationID"),
        k.alias("DOLocationID"),
        (k % 4 + 1).alias("payment_type"),
        F.col("value").alias("fare_amount"),
        F.lit(0.5).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        tip.alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(0.3).alias("improvement_surcharge"),
        (F.col("value") + F.coalesce(tip, F.lit(0.0))).alias("total_amount"),
        F.when(k % 2 == 0, F.lit(2.5)).alias("congestion_surcharge"),
        F.lit(None).cast("double").alias("airport_fee"),
        *[name for name in events.columns if name not in own],
    )


def raw_trips(
    spark: SparkSession,
    folder: str,
    with_metadata: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """All trips; a trip ends when the same user's next event begins."""
    events = table(spark, folder, "events")
    if with_metadata:
        events = add_ingest_metadata(events)
    return shape_trips(
        add_next_time(
            parse_events(events), "user_id", "ts", "event_id", "next_ts", hot_rows
        )
    )
