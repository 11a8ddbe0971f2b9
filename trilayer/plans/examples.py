"""Change sets that the merge and version queries work on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trilayer.functions.times import add_time_partitions
from trilayer.operators.cleanse import enrich
from trilayer.operators.merge import (
    when_matched_delete,
    when_matched_update,
    when_not_matched_insert,
)

ORDER_VALUES = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]

ORDER_UPDATE = when_matched_update({"o_totalprice": "s.o_totalprice"}, "s.merge_operation = 'UPDATE'")
ORDER_DELETE = when_matched_delete("s.merge_operation = 'DELETE'")
ORDER_INSERT = when_not_matched_insert(condition="s.merge_operation = 'INSERT'")


def _exploded(df: DataFrame, choices: list[Column], output: str) -> DataFrame:
    """Each row once per choice that is not null, from a single scan."""
    each = df.withColumn(output, F.explode(F.array(*choices)))
    return each.filter(F.col(output).isNotNull())


def order_changes(orders: DataFrame) -> DataFrame:
    """Merge source: urgent orders cost 5 more, high-priority pending ones come in
    again under a new key, low-priority finished ones go."""
    changes = _exploded(
        orders,
        [
            F.when(F.col("o_orderpriority") == "1-URGENT", "UPDATE"),
            F.when(
                (F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderstatus") == "P"),
                "INSERT",
            ),
            F.when(
                (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "F"),
                "DELETE",
            ),
        ],
        "merge_operation",
    )
    kind = F.col("merge_operation")
    price = F.col("o_totalprice")
    return changes.withColumns(
        {
            "o_orderkey": F.when(kind == "INSERT", -1 - F.col("o_orderkey")).otherwise(
                F.col("o_orderkey")
            ),
            "o_totalprice": F.when(kind == "UPDATE", price + 5.0).otherwise(price),
        }
    )


def order_log(orders: DataFrame) -> DataFrame:
    """Three versions of orders: a write, an update and a merge, an hour apart."""
    priority = F.col("o_orderpriority")

    def change(version: int, op: str, operation: str, raised: float) -> Column:
        return F.struct(
            F.lit(version).cast("long").alias("version"),
            F.lit(f"2024-01-01 0{version}:00:00").cast("timestamp_ntz").alias("commit_ts"),
            F.lit(op).alias("op"),
            F.lit(operation).alias("operation"),
            F.lit(raised).alias("raised"),
        )

    changes = _exploded(
        orders,
        [
            F.when(priority != "5-LOW", change(0, "INSERT", "WRITE", 0.0)),
            F.when(priority == "1-URGENT", change(1, "UPDATE", "UPDATE", 5.0)),
            F.when(priority == "2-HIGH", change(2, "UPDATE", "MERGE", 5.0)),
            F.when(priority == "5-LOW", change(2, "INSERT", "MERGE", 0.0)),
            F.when(priority == "3-MEDIUM", change(2, "DELETE", "MERGE", 0.0)),
        ],
        "_change",
    )
    return changes.select(
        *[name for name in orders.columns if name != "o_totalprice"],
        (F.col("o_totalprice") + F.col("_change.raised")).alias("o_totalprice"),
        "_change.version",
        "_change.commit_ts",
        "_change.op",
        "_change.operation",
    )


TRIP_KEY = [
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "pickup_location_id",
    "dropoff_location_id",
    "passenger_count",
]
TRIP_UPDATE = when_matched_update(
    {
        "tip_amount": "s.tip_amount",
        "total_amount": "s.total_amount",
        "data_source_quality": "'Updated Tip'",
    },
    "s.merge_operation = 'UPDATE'",
)
TRIP_INSERT = when_not_matched_insert(condition="s.merge_operation = 'INSERT'")


def trip_changes(silver: DataFrame) -> DataFrame:
    """Merge source: well-tipped trips get 5 more tip, very well-tipped ones also stand
    for two later trips each. Columns that a part lacks are null."""
    updates = silver.filter("tip_amount > 50").withColumns(
        {
            "tip_amount": F.col("tip_amount") + 5.0,
            "total_amount": F.col("total_amount") + 5.0,
            "merge_operation": F.lit("UPDATE"),
        }
    )
    model = silver.filter("tip_amount > 75")

    def later(start: str, end: str, dropoff: int, tip: float, number: int) -> DataFrame:
        base = "tpep_pickup_datetime + interval 365 days"
        times = model.withColumns(
            {
                "tpep_pickup_datetime": F.expr(f"{base} - {start}"),
                "tpep_dropoff_datetime": F.expr(f"{base} - {end}"),
                "event_id": -2 * F.col("event_id") - number,
                "passenger_count": F.lit(2),
                "dropoff_location_id": F.lit(dropoff),
                "tip_amount": F.lit(tip),
                "fare_amount": F.lit(41.5),
                "total_amount": F.lit(52.25),
                "trip_distance": F.lit(9.6),
                "data_source_quality": F.lit("New"),
                "merge_operation": F.lit("INSERT"),
            }
        )
        return add_time_partitions(enrich(times))

    first = later("interval 2 hours", "interval 1 hour 30 minutes", 141, 8.88, 1)
    second = later("interval 3 hours", "interval 2 hour 15 minutes", 236, 4.44, 2)
    return updates.unionByName(first, allowMissingColumns=True).unionByName(
        second, allowMissingColumns=True
    )
