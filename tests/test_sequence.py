from __future__ import annotations

from datetime import datetime, timedelta

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from trilayer.operators.sequence import add_next_time, hot_groups

START = datetime(2024, 1, 1)
SCHEMA = "user long, ts timestamp_ntz, id long"


def frame(spark, events):
    data = [
        (user, None if minute is None else START + timedelta(minutes=minute), number)
        for number, (user, minute) in enumerate(events)
    ]
    return spark.createDataFrame(data, SCHEMA), data


def brute_force(data):
    expected = []
    for user, ts, number in data:
        later = sorted(
            (other_ts, other_number)
            for other, other_ts, other_number in data
            if other == user and other_ts is not None and ts is not None
            and (other_ts, other_number) > (ts, number)
        )
        expected.append((user, ts, number, later[0][0] if later else None))
    return sorted(expected, key=lambda row: [(v is not None, str(v)) for v in row])


def test_hot_key_is_cut_into_slices(spark):
    # One user holds far more than a third of the rows, with ties and a gap.
    events = [(1, minute // 2) for minute in range(90)] + [(1, 5000), (1, 5000)]
    events += [(user, minute) for user in (2, 3, None) for minute in (7, 3, 3)]
    df, data = frame(spark, events)
    assert hot_groups(df, ["user"], "ts", "id", 10).count() == 1
    sliced = add_next_time(df, "user", "ts", "id", "next", hot_rows=10)
    plain = add_next_time(df, "user", "ts", "id", "next")
    assert rows(sliced) == rows(plain) == brute_force(data)


def test_null_key_can_be_hot_and_null_times_get_null(spark):
    events = [(None, minute) for minute in range(30)] + [(None, None), (1, None), (1, 4)]
    df, data = frame(spark, events)
    sliced = add_next_time(df, "user", "ts", "id", "next", hot_rows=5)
    assert rows(sliced) == brute_force(data)
    assert rows(add_next_time(df, "user", "ts", "id", "next")) == brute_force(data)


def test_slices_bound_the_rows_of_a_task(spark):
    df, _ = frame(spark, [(1, minute) for minute in range(400)])
    hot = hot_groups(df, ["user"], "ts", "id", 50).first()
    width_minutes = hot["_width"] / 60_000_000
    assert width_minutes <= 400 / 8


def test_a_burst_is_cut_again(spark):
    # Nearly all rows of the hot user fall into one of a hundred days.
    burst = [(1, 60_000 + n // 3) for n in range(120)]
    events = [(1, day * 1440) for day in range(100)] + burst + [(2, 5), (2, 6)]
    df, data = frame(spark, events)
    sliced = add_next_time(df, "user", "ts", "id", "next", hot_rows=15)
    assert rows(sliced) == brute_force(data)


def test_equal_times_are_cut_by_the_tie(spark):
    events = [(1, 5)] * 60 + [(1, 4)] * 3 + [(1, 9), (2, 5), (1, None), (1, None)]
    df, data = frame(spark, events)
    sliced = add_next_time(df, "user", "ts", "id", "next", hot_rows=10)
    assert rows(sliced) == brute_force(data)
    assert sliced.filter("user = 1 and next is null").count() == 3


def test_plan_does_not_grow_with_the_number_of_cuts(spark, folder):
    burst = [(1, 600_000 + n // 9) for n in range(200)]
    events = burst + [(1, day * 14_400) for day in range(120)] + [(2, 5), (2, 6)]
    df, data = frame(spark, events)
    df.write.parquet(folder)
    df = spark.read.parquet(folder)
    scans = {}
    for hot_rows in (1000, 100, 20, 8):
        found = add_next_time(df, "user", "ts", "id", "next", hot_rows=hot_rows)
        assert rows(found) == brute_force(data)
        plan = found._jdf.queryExecution().sparkPlan().toString()
        scans[hot_rows] = plan.count("FileScan")
    assert scans[1000] == 1
    assert max(scans.values()) <= 2


@settings(
    max_examples=10,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    st.lists(
        st.tuples(st.sampled_from([1, 2, None]), st.one_of(st.none(), st.integers(0, 9), st.integers(0, 500))), min_size=1, max_size=40
    )
)
def test_any_split_gives_the_same_rows(spark, events):
    df, data = frame(spark, events)
    assert rows(add_next_time(df, "user", "ts", "id", "next", hot_rows=3)) == brute_force(data)
