from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from trilayer.sources import writers
from trilayer.sources.raw import list_files, read_raw
from trilayer.sources.writers import (
    SchemaMismatch,
    append_checked,
    append_evolving,
    read_evolved,
    register_external,
    schema_diff,
    use_database,
    write_layer,
)


def batch(spark, *values):
    return spark.createDataFrame([(v, f"n{v}") for v in values], "k int, name string")


def test_overwrite_may_change_the_schema(spark, folder):
    write_layer(batch(spark, 1), folder)
    write_layer(spark.range(2), folder)
    assert read_raw(spark, folder).columns == ["id"]


def test_partitioned_write_and_dynamic_overwrite(spark, folder):
    df = spark.range(20).withColumn("part", F.col("id") % 2)
    write_layer(df, folder, partition_by=["part"], rebalance=True)
    assert rows(read_raw(spark, folder).groupBy("part").count()) == [(0, 10), (1, 10)]
    write_layer(
        spark.range(3).withColumn("part", F.lit(1)),
        folder,
        partition_by=["part"],
        replace_only_written_partitions=True,
    )
    assert rows(read_raw(spark, folder).groupBy("part").count()) == [(0, 10), (1, 3)]


def test_rebalanced_tasks_stay_small(spark, folder, monkeypatch):
    monkeypatch.setattr(writers, "TASK_BYTES", 100_000)
    df = spark.range(0, 100_000, 1, 8).select("id", F.rand(1).alias("r"), F.lit(1).alias("part"))
    write_layer(df, folder, partition_by=["part"], rebalance=True, file_bytes=1 << 30)
    assert list_files(spark, folder).count() > 4
    assert read_raw(spark, folder).agg(F.sum("id")).first()[0] == sum(range(100_000))
    # more directories in a task than it keeps open
    df = spark.range(0, 1000, 1, 2).withColumn("part", F.col("id") % (3 * writers.OPEN_FILES))
    write_layer(df, folder, partition_by=["part"], rebalance=True)
    found = read_raw(spark, folder).groupBy("part").agg(F.count("*"), F.sum("id"))
    assert rows(found) == rows(df.groupBy("part").agg(F.count("*"), F.sum("id")))


def test_schema_diff(spark):
    table = batch(spark, 1).schema
    assert not schema_diff(table, batch(spark, 2).select("name", "k").schema)
    other = batch(spark, 1).select(F.col("k").cast("long"), F.lit(1).alias("more")).schema
    diff = schema_diff(table, other)
    assert (diff.missing, diff.extra, diff.retyped) == (("name",), ("more",), ("k",))


@pytest.mark.parametrize(
    "change",
    [
        lambda df: df.drop("name"),
        lambda df: df.withColumn("more", F.lit(1)),
        lambda df: df.withColumn("k", F.col("k").cast("long")),
    ],
)
def test_checked_append_writes_nothing_on_mismatch(spark, folder, change):
    write_layer(batch(spark, 1), folder)
    with pytest.raises(SchemaMismatch):
        append_checked(change(batch(spark, 2)), folder)
    assert read_raw(spark, folder).count() == 1
    append_checked(batch(spark, 2), folder)
    assert rows(read_raw(spark, folder).select("k")) == [(1,), (2,)]


def test_checked_append_to_partitions_of_a_given_schema(spark, folder):
    df = spark.range(4).withColumn("part", F.col("id") % 2)
    write_layer(df, folder, partition_by=["part"])
    append_checked(df, folder, ["part"], df.schema)
    assert read_raw(spark, folder).count() == 8


def test_evolving_append(spark, folder):
    write_layer(batch(spark, 1), folder)
    schema = append_evolving(batch(spark, 2).withColumn("quality", F.lit("Good")), folder)
    assert schema.names == ["k", "name", "quality"]
    expected = [(1, "n1", None), (2, "n2", "Good")]
    assert rows(read_evolved(spark, folder, schema)) == expected
    assert rows(read_evolved(spark, folder)) == expected
    # A batch without the new column is still fine, a changed type is not.
    append_evolving(batch(spark, 3), folder)
    assert rows(read_evolved(spark, folder, schema))[2] == (3, "n3", None)
    with pytest.raises(SchemaMismatch):
        append_evolving(batch(spark, 4).withColumn("k", F.lit("x")), folder)


def test_external_table_lists_its_partitions_and_keeps_its_files(spark, folder):
    df = spark.range(4).withColumn("year", F.lit(2024)).withColumn("month", F.col("id") % 2)
    write_layer(df, folder, partition_by=["year", "month"])
    use_database(spark, "layers")
    try:
        register_external(spark, "layers.trips", folder, "a month's trips")
        register_external(spark, "layers.trips", folder)  # again: no error
        assert spark.table("layers.trips").count() == 4
        parts = {row[0] for row in spark.sql("SHOW PARTITIONS layers.trips").collect()}
        assert parts == {"year=2024/month=0", "year=2024/month=1"}
        detail = {row[0]: row[1] for row in spark.sql("DESCRIBE EXTENDED layers.trips").collect()}
        assert detail["Type"] == "EXTERNAL" and detail["Comment"] == "a month's trips"
        spark.sql("DROP TABLE IF EXISTS layers.trips")
        assert read_raw(spark, folder).count() == 4
    finally:
        spark.catalog.setCurrentDatabase("default")
        spark.sql("DROP DATABASE IF EXISTS layers CASCADE")
