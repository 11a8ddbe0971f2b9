from __future__ import annotations

from datetime import datetime

from conftest import rows

from trilayer.operators import gold

SILVER = (
    "tpep_pickup_datetime timestamp, pickup_year int, pickup_month int, "
    "pickup_location_id int, vendor_id int, trip_distance double, fare_amount double, "
    "tip_amount double, total_amount double, trip_duration_minutes double"
)


def silver(spark):
    first, second = datetime(2023, 1, 1, 23, 59), datetime(2023, 1, 2)
    return spark.createDataFrame(
        [
            (first, 2023, 1, 1, 1, 1.0, 10.005, 1.0, 11.0, 5.0),
            (first, 2023, 1, 1, 2, 2.0, 20.0, None, 20.0, 6.0),
            (first, 2023, 1, 2, None, None, 5.0, 0.0, 5.0, 7.0),
            (second, 2023, 1, 2, 1, 4.0, 1.0, 0.5, 1.5, 8.0),
            (second, 2023, 1, 2, 1, 4.0, 1.0, 0.5, 1.5, 8.0),
        ],
        SILVER,
    )


def test_daily_summary_ignores_nulls_in_averages_but_counts_rows(spark):
    found = gold.daily_summary(silver(spark)).orderBy("trip_date").collect()
    assert tuple(found[0]) == (datetime(2023, 1, 1), 3, 1.5, 35.01, 1.0, 6.0)
    assert tuple(found[1]) == (datetime(2023, 1, 2), 2, 4.0, 2.0, 1.0, 8.0)


def test_zone_summary_with_and_without_partitions(spark):
    found = gold.zone_order(gold.zone_summary(silver(spark))).collect()
    assert [row["pickup_location_id"] for row in found] == [2, 1]
    assert [row["distinct_vendors_count"] for row in found] == [1, 2]
    bare = gold.zone_summary(silver(spark).drop("pickup_year", "pickup_month"))
    assert bare.columns[0] == "pickup_location_id"
    assert rows(bare.select("pickup_location_id", "total_trips")) == [(1, 2), (2, 3)]


def test_revenue_summary(spark):
    found = gold.revenue_summary(silver(spark)).orderBy("trip_date").collect()
    assert [tuple(row)[1:] for row in found] == [(3, 1.5, 36.0), (2, 4.0, 3.0)]


def test_average_of_nothing_is_null(spark):
    df = silver(spark).filter("tip_amount is null")
    averaged = gold.average_per(df, ["vendor_id"], "tip_amount", "tip")
    assert rows(averaged) == [(2, None)]


def test_sums_do_not_depend_on_partitioning(spark):
    df = spark.range(2000).selectExpr("cast(id * 0.0101 as double) v", "1 as k")
    results = {
        gold.average_per(df.repartition(n), ["k"], "v", "a").first()["a"] for n in (1, 3, 16)
    }
    assert len(results) == 1


def test_first_rows_and_rows_per(spark):
    df = spark.range(20)
    assert [row[0] for row in gold.first_rows(df, 3, df["id"].desc()).collect()] == [19, 18, 17]
    assert rows(gold.rows_per(silver(spark), "vendor_id")) == [(None, 1), (1, 3), (2, 1)]
