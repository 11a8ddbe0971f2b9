from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from trilayer.operators import cleanse, gold
from trilayer.plans import layers
from trilayer.plans.catalogue import QUERIES, silver_by_day
from trilayer.plans.facts import cached, plan_facts
from trilayer.session import SHUFFLE_BYTES, conf
from trilayer.sources.trips import raw_trips

DATA = "/root/testdata/sf0.001"


def facts(spark, name):
    return plan_facts(QUERIES[name](spark, DATA))


def test_partition_filter_prunes(spark):
    found = facts(spark, "pruned_avg")
    assert "pickup_year" in found.partition_filters[0]
    assert "tip_amount" in found.read_schemas[0] and "fare_amount" not in found.read_schemas[0]


def test_days_that_are_not_asked_for_are_not_read(spark):
    days = silver_by_day(spark, DATA)
    some = days.filter("pickup_day BETWEEN 5 AND 7")
    assert 0 < some.count() < days.count()
    assert "pickup_day" in plan_facts(some).partition_filters[0]
    read = some.select("_metadata.file_path").distinct().count()
    assert 0 < read < days.select("_metadata.file_path").distinct().count()


def test_data_filters_and_columns_reach_the_scan(spark):
    found = facts(spark, "filtered_avg")
    assert "GreaterThan(tip_amount,50.0)" in found.pushed_filters[0]
    assert "fare_amount" not in found.read_schemas[0]
    assert "GreaterThan(trip_distance,10.0)" in facts(spark, "long_trips").pushed_filters[0]


@pytest.mark.parametrize("name", ["join_daily_broadcast_df", "join_daily_broadcast_sql"])
def test_measured_daily_table_is_broadcast(spark, name):
    found = facts(spark, name)
    assert found.has("BroadcastHashJoin") and not found.has("Exchange")


def test_flagship_shuffles_by_user_then_by_day(spark):
    found = plan_facts(gold.daily_summary(cleanse.silver(raw_trips(spark, DATA))))
    assert found.nodes["Exchange"] == 2
    assert found.nodes["Window"] == 1
    assert not any(node.endswith("Python") for node in found.nodes)


def test_top_k_is_not_a_full_sort(spark):
    assert facts(spark, "earliest_trips").has("TakeOrderedAndProject")


def test_layers_are_written_once(spark):
    first = layers.silver_table(spark, DATA).inputFiles()
    assert layers.silver_table(spark, DATA).inputFiles() == first


def test_cached_result_is_released(spark):
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    with cached(df) as kept:
        assert kept.count() == 10
        assert plan_facts(kept.agg(F.sum("v"))).has("InMemoryTableScan")
    assert not df.storageLevel.useMemory


def test_tasks_of_a_session_made_elsewhere_are_bounded(spark):
    name, size = SHUFFLE_BYTES
    with conf(spark, {name: size}):
        spark.conf.unset(name)
        QUERIES["merge_metrics"](spark, "/root/testdata/sf0.001")
        assert spark.conf.get(name) == size
        spark.conf.set(name, "5m")
        QUERIES["merge_metrics"](spark, "/root/testdata/sf0.001")
        assert spark.conf.get(name) == "5m"
