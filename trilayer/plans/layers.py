"""The written bronze, silver and gold tables of a folder of input tables.

Each is written once per session and input; queries on a layer then read its files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilayer.functions.times import add_time_partitions
from trilayer.operators.cleanse import silver
from trilayer.operators.gold import daily_summary
from trilayer.sources.raw import list_files, read_raw
from trilayer.sources.trips import raw_trips
from trilayer.sources.writers import register_external, write_layer
from trilayer.workspace import layer_paths, new_dir


def _input(spark: SparkSession, folder: str) -> tuple:
    """What the layers are derived from: session, folder and state of its files."""
    files = list_files(spark, f"{folder}/events.parquet").agg(
        F.count("*"), F.sum("length"), F.max("modificationTime")
    )
    return spark.sparkContext.applicationId, folder, *files.first()


def build_bronze(spark: SparkSession, folder: str) -> DataFrame:
    return add_time_partitions(raw_trips(spark, folder, with_metadata=True))


def _parts(name: str) -> list[str]:
    return [] if name == "gold_daily" else ["pickup_year", "pickup_month"]


def _layer(spark: SparkSession, folder: str, name: str) -> DataFrame:
    key = (*_input(spark, folder), name)
    if key not in layer_paths:
        if name == "bronze":
            rows = build_bronze(spark, folder)
        elif name == "silver":
            rows = silver(bronze_table(spark, folder))
        else:
            rows = daily_summary(silver_table(spark, folder))
        parts = _parts(name)
        path = new_dir(spark, name)
        write_layer(rows, path, partition_by=parts, rebalance=bool(parts))
        layer_paths[key] = path, rows.schema
    path, schema = layer_paths[key]
    return read_raw(spark, path, schema=schema)


def named_layer(spark: SparkSession, folder: str, name: str, comment: str | None = None) -> str:
    """The name under which the catalog knows a layer's files; registered at first use.

    The name ends in the mark of the layer's path, so tables of other inputs stay apart.
    """
    _layer(spark, folder, name)
    path, schema = layer_paths[(*_input(spark, folder), name)]
    known = f"{name}_{path.rpartition('-')[2]}"
    register_external(spark, known, path, comment, schema, _parts(name))
    return known


def bronze_table(spark: SparkSession, folder: str) -> DataFrame:
    return _layer(spark, folder, "bronze")


def silver_table(spark: SparkSession, folder: str) -> DataFrame:
    return _layer(spark, folder, "silver")


def gold_daily_table(spark: SparkSession, folder: str) -> DataFrame:
    return _layer(spark, folder, "gold_daily")
