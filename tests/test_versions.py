from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trilayer.operators.versions import (
    change_history,
    revert_changes,
    state_as_of,
    version_before,
)

SCHEMA = "k int, v double, version long, commit_ts timestamp_ntz, op string, operation string"
T0 = datetime(2024, 1, 1)


def log(spark, changes):
    data = [
        (k, v, version, T0 + timedelta(hours=version), op, operation)
        for k, v, version, op, operation in changes
    ]
    return spark.createDataFrame(data, SCHEMA)


CHANGES = [
    (1, 1.0, 0, "INSERT", "WRITE"),
    (2, 2.0, 0, "INSERT", "WRITE"),
    (None, 9.0, 0, "INSERT", "WRITE"),
    (1, 1.5, 1, "UPDATE", "UPDATE"),
    (2, 2.0, 2, "DELETE", "MERGE"),
    (3, None, 2, "INSERT", "MERGE"),
    (2, 2.5, 3, "INSERT", "WRITE"),
]


def test_history(spark):
    assert rows(change_history(log(spark, CHANGES)).drop("commit_ts")) == [
        (0, "WRITE", 3, 0, 0),
        (1, "UPDATE", 0, 1, 0),
        (2, "MERGE", 1, 0, 1),
        (3, "WRITE", 1, 0, 0),
    ]


def test_states(spark):
    df = log(spark, CHANGES)

    def at(**when):
        return rows(state_as_of(df, ["k"], ["v"], **when))

    assert at(version=0) == [(None, 9.0), (1, 1.0), (2, 2.0)]
    assert at(version=1) == [(None, 9.0), (1, 1.5), (2, 2.0)]
    assert at(version=2) == [(None, 9.0), (1, 1.5), (3, None)]
    assert at() == at(version=3) == [(None, 9.0), (1, 1.5), (2, 2.5), (3, None)]
    assert at(version=-1) == []
    assert at(timestamp="2024-01-01 01:59:59.999999") == at(version=1)
    assert at(timestamp="2024-01-01 02:00:00.000000") == at(version=2)
    assert at(timestamp="2023-12-31 00:00:00") == []


def test_version_before(spark):
    assert tuple(version_before(log(spark, CHANGES)).first()) == (3, 0, 1)
    plain = log(spark, CHANGES[:4])
    assert tuple(version_before(plain).first()) == (1, 0, None)
    assert tuple(version_before(log(spark, CHANGES[:3])).first()) == (0, None, None)


def test_revert(spark):
    df = log(spark, CHANGES)
    undo = revert_changes(df, ["k"], ["v"], 1, F.lit("2024-01-02").cast("timestamp_ntz"))
    assert rows(undo.select("k", "v", "version", "op", "operation")) == [
        (2, 2.0, 4, "UPDATE", "RESTORE"),
        (3, None, 4, "DELETE", "RESTORE"),
    ]
    grown = df.unionByName(undo)
    assert rows(state_as_of(grown, ["k"], ["v"])) == rows(state_as_of(df, ["k"], ["v"], 1))
    # History before the revert is still there.
    assert rows(state_as_of(grown, ["k"], ["v"], 3)) == rows(state_as_of(df, ["k"], ["v"]))


def test_revert_to_a_time(spark):
    changes = [(1, 1.0, 0, "INSERT", "WRITE"), (1, 2.0, 1, "UPDATE", "WRITE"), (2, 5.0, 2, "INSERT", "WRITE")]
    df = log(spark, changes)
    times = [row[0] for row in df.orderBy("version").select("commit_ts").collect()]
    undo = revert_changes(df, ["k"], ["v"], timestamp=str(times[1]))
    assert rows(state_as_of(df.unionByName(undo), ["k"], ["v"])) == [(1, 2.0)]
    with pytest.raises(ValueError):
        revert_changes(df, ["k"], ["v"])


def test_a_key_with_very_many_changes(spark):
    changes = [(1, float(n), n, "UPDATE" if n else "INSERT", "WRITE") for n in range(300)]
    df = log(spark, changes + [(2, 0.0, 0, "INSERT", "WRITE")]).repartition(4)
    assert rows(state_as_of(df, ["k"], ["v"], version=250)) == [(1, 250.0), (2, 0.0)]


steps = st.lists(
    st.tuples(st.sampled_from([1, 2, 3]), st.integers(0, 3), st.booleans()), min_size=1, max_size=15
)


@settings(
    max_examples=6,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(steps, st.integers(0, 14))
def test_any_log_can_be_reverted(spark, changes, back):
    state, history, entries = {}, [], []
    for version, (key, value, delete) in enumerate(changes):
        if delete and key in state:
            entries.append((key, state.pop(key), version, "DELETE", "WRITE"))
        else:
            op = "UPDATE" if key in state else "INSERT"
            state[key] = float(value)
            entries.append((key, state[key], version, op, "WRITE"))
        history.append(dict(state))
    version = min(back, len(changes) - 1)
    df = log(spark, entries)
    assert rows(state_as_of(df, ["k"], ["v"], version)) == sorted(history[version].items())
    undo = revert_changes(df, ["k"], ["v"], version, F.lit("2024-02-01").cast("timestamp_ntz"))
    restored = state_as_of(df.unionByName(undo), ["k"], ["v"])
    assert rows(restored) == sorted(history[version].items())
