from __future__ import annotations

import os
import time
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from trilayer.operators.quality import Rule, apply_rules, observe_rules
from trilayer.plans import catalogue
from trilayer.session import conf
from trilayer.sources.raw import read_raw, stream_files, stream_table
from trilayer.streaming import trips as streams
from trilayer.streaming.runner import finish, read_complete, run_stream, start_stream

SCHEMA = "tpep_pickup_datetime timestamp, pickup_location_id int"
START = datetime(2024, 1, 1)


@pytest.fixture
def landing(spark, tmp_path):
    """A folder that files are put into one by one, each newer than the last."""
    count = [0]

    def land(*minutes, zone=1):
        count[0] += 1
        part = tmp_path / f"part{count[0]}"
        data = [(START + timedelta(minutes=m), zone) for m in minutes]
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(str(part))
        (file,) = part.glob("*.parquet")
        target = tmp_path / "in" / f"{count[0]}.parquet"
        target.parent.mkdir(exist_ok=True)
        target.write_bytes(file.read_bytes())
        stamp = time.time() - 1000 + count[0]
        os.utime(target, (stamp, stamp))

    land.path = str(tmp_path / "in")
    land.out = str(tmp_path / "out")
    land.checkpoint = str(tmp_path / "checkpoint")
    return land


def counted(spark, landing, **how):
    source = stream_files(
        spark, landing.path, read_raw(spark, landing.path).schema, max_files_per_trigger=1
    )
    return run_stream(
        streams.window_counts(source),
        checkpoint=landing.checkpoint,
        path=landing.out,
        timeout=120,
        **how,
    )


def minutes(df):
    flat = streams.flat_windows(df).select("window_start", "trip_count").collect()
    return sorted(
        (int((row["window_start"] - START).total_seconds() // 60), row["trip_count"])
        for row in flat
    )


def test_append_emits_closed_windows_only_and_restart_reads_nothing_twice(spark, landing):
    landing(1, 2, 11)
    landing(45)
    counted(spark, landing)
    # The watermark is at minute 25: the window 10-20 is closed, 40-50 is not.
    assert minutes(read_raw(spark, landing.out)) == [(0, 2), (10, 1)]
    again = counted(spark, landing)
    assert sum(p["numInputRows"] for p in again.recentProgress) == 0
    assert minutes(read_raw(spark, landing.out)) == [(0, 2), (10, 1)]
    landing(47, 90)
    counted(spark, landing)
    assert minutes(read_raw(spark, landing.out)) == [(0, 2), (10, 1), (40, 2)]


def test_rows_behind_the_watermark_are_dropped(spark, landing):
    landing(1, 2)
    landing(60)
    landing(61)  # the watermark of the batch before is what counts
    landing(3)  # late
    landing(120)
    counted(spark, landing)
    assert minutes(read_raw(spark, landing.out)) == [(0, 2), (60, 2)]


def test_update_mode_keeps_the_newest_count(spark, landing):
    landing(1, 2)
    landing(3, 12)
    counted(spark, landing, mode="update")
    found = streams.read_updates(spark, landing.out)
    assert minutes(found) == [(0, 3), (10, 1)]


def test_complete_mode_keeps_the_whole_result(spark, landing):
    landing(1, 2)
    landing(3, 12)
    landing(13)
    counted(spark, landing, mode="complete")
    assert minutes(read_complete(spark, landing.out)) == [(0, 3), (10, 2)]


def test_streaming_equals_batch_for_closed_windows(spark, landing):
    landing(*range(0, 60, 3))
    landing(*range(60, 200, 7), zone=2)
    counted(spark, landing)
    batch = streams.window_counts(read_raw(spark, landing.path))
    newest = START + timedelta(minutes=60 + 7 * 19)
    closed = batch.filter(F.col("window.end") <= F.lit(newest - timedelta(minutes=20)))
    assert rows(read_raw(spark, landing.out)) == rows(closed)


def test_chain_through_a_catalog_table(spark, landing):
    landing(1, 2, 45)
    schema = read_raw(spark, landing.path).schema
    bronze = streams.with_stream_metadata(stream_files(spark, landing.path, schema, "*.parquet"))
    try:
        run_stream(
            streams.bronze_stream(bronze),
            checkpoint=f"{landing.checkpoint}1",
            path=f"{landing.out}1",
            table="streamed_bronze",
            name="bronze",
        )
        stored = spark.table("streamed_bronze")
        assert stored.count() == 3
        assert stored.select("streaming_source_file").first()[0].endswith("1.parquet")
        run_stream(
            streams.window_counts(stream_table(spark, "streamed_bronze", 10)),
            checkpoint=f"{landing.checkpoint}2",
            path=f"{landing.out}2",
        )
        assert minutes(read_raw(spark, f"{landing.out}2")) == [(0, 2)]
    finally:
        spark.sql("DROP TABLE IF EXISTS streamed_bronze")


def test_bronze_stream_casts_and_renames(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:00", 5)], "tpep_pickup_datetime string, PULocationID int"
    )
    found = streams.bronze_stream(df)
    assert dict(found.dtypes) == {
        "tpep_pickup_datetime": "timestamp",
        "pickup_location_id": "int",
    }


def test_state_store_is_set_for_the_stream_only(spark, landing):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    landing(1, 50)
    query = counted(spark, landing, state_partitions=2)
    state = query.recentProgress[0]["stateOperators"][0]
    assert state["numShufflePartitions"] == 2
    assert spark.conf.get(key, None) == before
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_interval_trigger_runs_until_stopped(spark, landing):
    landing(1)
    schema = read_raw(spark, landing.path).schema
    query = start_stream(
        stream_files(spark, landing.path, schema),
        checkpoint=landing.checkpoint,
        path=landing.out,
        interval="1 second",
    )
    query.processAllAvailable()
    landing(2)
    query.processAllAvailable()
    assert query.isActive
    with pytest.raises(TimeoutError):
        finish(query, timeout=1)
    assert not query.isActive
    assert read_raw(spark, landing.out).count() == 2


def test_rules_on_a_stream(spark, landing):
    landing(1, 2, zone=1)
    landing(3, zone=-1)
    schema = read_raw(spark, landing.path).schema

    def run(rules, number):
        source = stream_files(spark, landing.path, schema)
        return run_stream(
            apply_rules(observe_rules(source, rules), rules),
            checkpoint=f"{landing.checkpoint}{number}",
            path=f"{landing.out}{number}",
        )

    query = run([Rule("zone", "pickup_location_id > 0", "drop")], 1)
    assert read_raw(spark, f"{landing.out}1").count() == 2
    seen = [p["observedMetrics"]["rules"] for p in query.recentProgress if p["observedMetrics"]]
    assert sum(s["rows"] for s in seen) == 3 and sum(s["zone"] for s in seen) == 1
    run([Rule("zone", "pickup_location_id > 0", "warn")], 2)
    assert read_raw(spark, f"{landing.out}2").count() == 3
    with pytest.raises(Exception, match="rule zone failed"):
        run([Rule("zone", "pickup_location_id > 0", "fail")], 3)


@pytest.mark.parametrize("name", ["stream_by_table", "declared_stream", "stream_join"])
def test_state_of_landed_streams_goes_by_the_rows_of_a_file(spark, monkeypatch, name):
    seen = []
    monkeypatch.setattr(
        catalogue, "run_stream",
        lambda *given, **how: seen.append(run_stream(*given, **how)) or seen[-1])
    with conf(spark, {"spark.sql.shuffle.partitions": "40"}):
        assert not catalogue.QUERIES[name](spark, "/root/testdata/sf0.001").isEmpty()
    states = [part for query in seen for part in query.lastProgress["stateOperators"]]
    assert {part["numShufflePartitions"] for part in states} == {10}
