from __future__ import annotations

import math

from pyspark.sql import functions as F

from trilayer.functions.exact import exact_avg, exact_sum, round2, rounded_sum
from trilayer.operators.gold import daily_summary

NAN = float("nan")


def results(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    return tuple(df.agg(exact_sum("v"), exact_avg("v"), rounded_sum("v")).first())


def test_small_and_large_amounts(spark):
    assert results(spark, [0.00004, 0.00002]) == (0.00006, 0.00003, 0.0)
    assert results(spark, [0.123456, 0.000001, None]) == (0.123457, 0.0617285, 0.12)
    assert results(spark, [1e15, 2.5]) == (1e15 + 2.5, 5e14 + 1.25, 1e15 + 2.5)
    assert results(spark, [0.005, 0.0]) == (0.005, 0.0025, 0.01)


def test_nothing_and_nan(spark):
    assert results(spark, [None]) == results(spark, []) == (None, None, None)
    assert all(math.isnan(v) for v in results(spark, [NAN, 2.0, None]))
    df = spark.createDataFrame([(NAN,), (None,), (1.005,)], "v double").select(round2(F.col("v")))
    found = [r[0] for r in df.collect()]
    assert math.isnan(found[0]) and found[1:] == [None, 1.01]


def test_nan_reaches_gold_as_nan(spark):
    rows = spark.sql(
        "SELECT timestamp '2024-01-01 05:00:00' AS tpep_pickup_datetime, v AS trip_distance, "
        "1.0D AS fare_amount, v AS tip_amount, 2.0D AS trip_duration_minutes "
        "FROM VALUES (double('NaN')), (1.0D) AS t(v)"
    )
    found = daily_summary(rows).first()
    assert math.isnan(found["average_trip_distance_miles"])
    assert math.isnan(found["total_tip_amount"])
    assert found["total_fare_amount"] == 2.0


INF = float("inf")


def same(found, want):
    return all(math.isnan(a) if math.isnan(b) else a == b for a, b in zip(found, want))


def test_infinite_amounts_count_as_in_a_plain_sum(spark):
    assert results(spark, [1.0, INF]) == (INF, INF, INF)
    assert results(spark, [-INF, 2.0, None]) == (-INF, -INF, -INF)
    assert same(results(spark, [INF, -INF, 1.0]), [NAN, NAN, NAN])
    assert same(results(spark, [INF, NAN]), [NAN, NAN, NAN])
    df = spark.createDataFrame([(INF,), (-INF,), (2.675,)], "v double").select(round2(F.col("v")))
    assert [r[0] for r in df.collect()] == [INF, -INF, 2.68]
    for values in ([INF, 1.0], [INF, -INF], [NAN], [1.0, 2.0], []):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        plain = df.agg(F.sum("v"), F.avg("v")).first()
        found = df.agg(exact_sum("v"), exact_avg("v")).first()
        assert found[:] == plain[:] if None in plain[:] else same(found, plain)


def test_infinities_reach_gold(spark, folder):
    """The same figures from the SQL twin of the averages and sums."""
    import duckdb

    from trilayer.plans import oracles

    spark.sql(
        "SELECT id, CASE id % 4 WHEN 0 THEN double('Infinity') WHEN 1 THEN 1.25D WHEN 2 THEN "
        "double('-Infinity') ELSE double('NaN') END AS v, id % 7 AS k FROM range(0, 9)"
    ).coalesce(1).write.parquet(folder)
    rows = spark.read.parquet(folder)
    found = rows.groupBy("k").agg(rounded_sum("v").alias("s"), round2(exact_avg("v")).alias("a"))
    sql = (
        f"SELECT k, {oracles._rounded_sum('v')} AS s, {oracles._round2(oracles._average('v'))} AS a "
        f"FROM '{folder}/*.parquet' GROUP BY k"
    )
    want = {r[0]: r[1:] for r in duckdb.connect().execute(sql).fetchall()}
    for row in found.collect():
        assert same(row[1:], want[row["k"]])
