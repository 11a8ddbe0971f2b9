from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from trilayer.sources.raw import read_raw, stream_files
from trilayer.streaming import sessions
from trilayer.streaming.runner import run_stream

START = datetime(2024, 1, 1)
EVENTS = "id int, user string, ts timestamp"


def at(minute):
    return START + timedelta(minutes=minute)


def land(spark, folder, rows, schema=EVENTS):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.createDataFrame([], schema).schema


def run(spark, folder, df, name, **how):
    run_stream(df, checkpoint=f"{folder}/{name}-check", path=f"{folder}/{name}", state_partitions=2, **how)
    return sorted(map(tuple, read_raw(spark, f"{folder}/{name}", schema=df.schema).collect()), key=str)


def stream(spark, path, schema):
    return stream_files(spark, path, schema, max_files_per_trigger=1)


def test_interval_join_over_batches_with_late_rows(spark, folder):
    left, right = f"{folder}/left", f"{folder}/right"
    other = "rid int, user string, rts timestamp"
    land(spark, left, [(1, "a", at(0)), (2, "a", at(5)), (3, "b", at(5)), (4, None, at(5))])
    land(spark, right, [(10, "a", at(3)), (11, "a", at(12)), (12, None, at(6))], other)
    land(spark, left, [(5, "b", at(60))])
    land(spark, right, [(13, "b", at(61))], other)
    land(spark, left, [(8, "z", at(70))])  # state of the first batch goes with this one
    land(spark, right, [(16, "y", at(70))], other)
    land(spark, left, [(6, "a", at(100)), (7, "a", at(2))])  # the second finds nothing left
    b = land(spark, right, [(14, "a", at(4)), (15, "a", at(101))], other)
    a = spark.createDataFrame([], EVENTS).schema
    joined = sessions.interval_join(
        stream(spark, left, a), stream(spark, right, b), ["user"], "ts", "rts", "10 minutes", "5 minutes", "5 minutes")
    found = run(spark, folder, joined, "pairs")
    assert [(r[0], r[3]) for r in found] == [(1, 10), (2, 11), (5, 13), (6, 15)]


def test_left_rows_without_a_partner_come_when_their_time_is_over(spark, folder):
    left, right = f"{folder}/left", f"{folder}/right"
    other = "rid int, user string, rts timestamp"
    a = land(spark, left, [(1, "a", at(0)), (2, "b", at(0))])
    b = land(spark, right, [(10, "a", at(1))], other)
    for minute in (50, 100):
        land(spark, left, [(minute, "z", at(minute))])
        land(spark, right, [(minute, "y", at(minute))], other)
    joined = sessions.interval_join(
        stream(spark, left, a), stream(spark, right, b), ["user"], "ts", "rts", "10 minutes", "5 minutes",
        "5 minutes", "left")
    found = run(spark, folder, joined, "pairs")
    assert (2, "b", at(0), None, None) in found and (1, "a", at(0), 10, at(1)) in found
    with pytest.raises(ValueError, match="ts"):
        sessions.interval_join(
            stream(spark, left, a), stream(spark, left, a), ["user"], "ts", "ts", "1 minute", "1 minute", "1 minute")


def test_sessions_count_repeats_once_and_survive_a_restart(spark, folder):
    source = f"{folder}/events"
    schema = land(spark, source, [(1, "a", at(0)), (1, "a", at(0)), (2, "a", at(5)), (3, "b", at(1))])

    def found():
        events = stream(spark, source, schema)
        return run(spark, folder, sessions.sessions(events, "user", "ts", "10 minutes", ["id"], "5 minutes"), "found")

    assert found() == []
    land(spark, source, [(2, "a", at(5)), (4, "a", at(9)), (5, "b", at(40))])
    assert found() == [("a", at(0), at(19), 3), ("b", at(1), at(11), 1)]
    land(spark, source, [(6, "b", at(45)), (5, "b", at(40)), (7, "a", at(3)), (8, "c", at(90))])
    assert found() == [("a", at(0), at(19), 3), ("b", at(1), at(11), 1), ("b", at(40), at(55), 2)]
