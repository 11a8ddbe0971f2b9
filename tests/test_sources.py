from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from trilayer.functions.times import add_time_partitions, partition_columns
from trilayer.sources.raw import (
    add_ingest_metadata,
    file_stream_location,
    infer_or_load_schema,
    read_raw,
    table,
)
from trilayer.workspace import new_dir, shared_dir

DATA = "/root/testdata/sf0.001"


def test_glob_picks_files(spark, folder):
    spark.range(3).write.parquet(f"{folder}/in")
    spark.range(2).selectExpr("cast(id as string) v").write.mode("append").text(f"{folder}/in")
    assert read_raw(spark, f"{folder}/in", glob="*.parquet").count() == 3


def test_metadata_names_the_file_of_each_row(spark):
    df = add_ingest_metadata(table(spark, DATA, "events"))
    row = df.select("source_file", "ingestion_timestamp").first()
    assert row["source_file"].endswith("/sf0.001/events.parquet")
    assert isinstance(row["ingestion_timestamp"], datetime)
    assert df.select("source_file").distinct().count() == 1


def test_time_partitions_only_where_the_event_time_is(spark):
    df = spark.createDataFrame(
        [(datetime(2023, 1, 31, 23, 59),)], "tpep_pickup_datetime timestamp_ntz"
    )
    added = add_time_partitions(df)
    assert tuple(added.first())[1:] == (2023, 1)
    assert partition_columns(added) == ["pickup_year", "pickup_month"]
    assert add_time_partitions(spark.range(1)).columns == ["id"]
    assert partition_columns(spark.range(1)) == []
    assert partition_columns(added.drop("pickup_year")) == []


def test_schema_is_remembered(spark, folder):
    spark.range(1).write.parquet(f"{folder}/in")
    first = infer_or_load_schema(spark, f"{folder}/in", f"{folder}/schema")
    spark.range(1).withColumn("extra", F.lit("x")).write.mode("overwrite").parquet(
        f"{folder}/in"
    )
    again = infer_or_load_schema(spark, f"{folder}/in", f"{folder}/schema")
    assert first == again
    assert again.names == ["id"]


def test_stream_location_of_a_file_and_of_a_folder(spark, folder):
    assert file_stream_location(spark, f"{DATA}/events.parquet") == (DATA, "events.parquet")
    spark.range(1).write.parquet(f"{folder}/events.parquet")
    assert file_stream_location(spark, f"{folder}/events.parquet") == (
        f"{folder}/events.parquet",
        None,
    )


def test_workspace_is_the_folder_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named.rstrip("/")
    assert new_dir(spark, "a") != new_dir(spark, "a")
    assert new_dir(spark, "a").startswith(shared_dir(spark))


def test_missing_input_is_an_error(spark):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        table(spark, "/root/testdata/none", "events")
