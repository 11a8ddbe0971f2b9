from __future__ import annotations

from pyspark.sql import functions as F

from trilayer.operators import sketches


def days_of(spark, rows=60_000):
    df = spark.range(rows).selectExpr(
        "timestamp'2024-01-01' + make_interval(0,0,0,int(id % 40)) AS at",
        "IF(id % 50 = 0, NULL, pmod(hash(id), 9000)) AS user",
        "CASE WHEN id % 97 = 0 THEN double('NaN') WHEN id % 89 = 0 THEN double('Infinity') "
        "WHEN id % 83 = 0 THEN NULL ELSE double(pmod(hash(id, 1), 100000)) END AS v",
    )
    return df, sketches.daily_sketches(df, ["user"], ["v"], "at")


def close(told, df):
    row = told.select(
        sketches.distinct_estimate("user").alias("users"), sketches.quantile_estimate("v", 0.5).alias("p50"),
        sketches.quantile_estimate("v", 0.99).alias("p99"), "trips",
    ).first()
    finite = df.filter("v < double('Infinity')")
    n, users = finite.count(), df.select("user").distinct().filter("user IS NOT NULL").count()
    assert row["trips"] == df.count()
    assert abs(row["users"] - users) <= users * sketches.DISTINCT_ERROR
    for name, rank in (("p50", 0.5), ("p99", 0.99)):
        assert abs(finite.filter(F.col("v") <= row[name]).count() / n - rank) <= sketches.RANK_ERROR


def test_days_months_and_everything(spark):
    df, days = days_of(spark)
    days = days.cache()
    assert days.count() == 40
    close(days.filter("trip_date = '2024-01-05'"), df.filter("date(at) = '2024-01-05'"))
    months = sketches.merged(days, F.date_trunc("month", "trip_date"))
    assert {r["period"].month: r["trips"] for r in months.collect()} == {1: 46_500, 2: 13_500}
    close(months.filter("period = '2024-02-01'"), df.filter("month(at) = 2"))
    whole = sketches.merged(months.withColumnRenamed("period", "trip_date"), F.lit(None).cast("timestamp"))
    close(whole, df)
    days.unpersist()


def test_the_way_of_merging_does_not_matter(spark):
    df, days = days_of(spark, 20_000)
    close(sketches.merged(days, F.lit(1)), df)
    again = sketches.daily_sketches(df.repartition(7), ["user"], ["v"], "at")
    close(sketches.merged(again, F.lit(1)), df)


def test_nothing_to_measure(spark):
    df = spark.createDataFrame([], "at timestamp, user int, v double")
    days = sketches.daily_sketches(df, ["user"], ["v"], "at")
    assert days.count() == 0 and sketches.merged(days, F.lit(1)).count() == 0
    odd = spark.sql("SELECT timestamp'2024-01-01' AS at, CAST(NULL AS INT) AS user, double('NaN') AS v")
    found = sketches.daily_sketches(odd, ["user"], ["v"], "at")
    found = found.select(sketches.distinct_estimate("user"), sketches.quantile_estimate("v", 0.5)).first()
    assert found[:] == (0, None)
