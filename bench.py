"""Seconds per query; prints one JSON line.

BENCH_SF_DIR   folder of input tables (default /root/testdata/sf0.1)
BENCH_CPUS     local threads (default 8)
BENCH_RUNS     timed runs per query, the median counts (default 3)

"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from statistics import median

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilayer.operators import gold, joins, layout
from trilayer.plans import layers
from trilayer.plans.catalogue import QUERIES
from trilayer.plans.facts import cached
from trilayer.session import build_session
from trilayer.sources.raw import read_raw, table
from trilayer.sources.writers import write_layer
from trilayer.workspace import new_dir, release

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(action, runs: int = RUNS) -> float:
    spent = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        spent.append(time.perf_counter() - start)
    return round(median(spent), 3)


def all_queries(spark: SparkSession) -> dict:
    for name in ("gold_daily_summary", "merge_upsert", "join_daily_total"):  # warm-up
        drain(QUERIES[name](spark, FOLDER))
    times = {
        name: seconds(lambda run=run: drain(run(spark, FOLDER)))
        for name, run in QUERIES.items()
    }
    scale = re.search(r"sf([0-9.]+)", FOLDER)
    return {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(scale.group(1)) if scale else None,
    }


def pairs(spark: SparkSession) -> dict:
    silver = layers.silver_table(spark, FOLDER)
    daily = layers.gold_daily_table(spark, FOLDER)

    by_day = new_dir(spark, "by_day")
    write_layer(
        silver.withColumn("pickup_day", F.dayofmonth("tpep_pickup_datetime")),
        by_day,
        partition_by=["pickup_day"],
        rebalance=True,
    )
    whole = new_dir(spark, "whole")
    write_layer(read_raw(spark, by_day), whole)

    def day_average(path: str) -> DataFrame:
        day = read_raw(spark, path).filter("pickup_day = 7")
        return gold.average_per(day, ["pickup_location_id"], "tip_amount", "avg_tip")

    def two_aggregates(df: DataFrame) -> None:
        drain(gold.average_per(df, ["passenger_count"], "fare_amount", "avg_fare"))
        drain(gold.rows_per(df, "vendor_id"))

    def with_cache() -> None:
        with cached(layers.silver_table(spark, FOLDER)) as kept:
            two_aggregates(kept)

    fragments, compacted, clustered = (new_dir(spark, n) for n in ("frag", "compact", "z"))
    lines = f"{FOLDER}/lineitem.parquet"
    write_layer(table(spark, FOLDER, "lineitem").repartition(400), fragments)
    layout.compact(spark, fragments, compacted)
    size = max(1, layout.table_bytes(spark, lines) // 16)
    layout.zorder_layout(spark, lines, clustered, ["l_partkey", "l_shipdate"], size)
    unordered = new_dir(spark, "unordered")
    write_layer(table(spark, FOLDER, "lineitem").repartition(16), unordered)

    def scan(path: str) -> None:
        lines = read_raw(spark, path).filter("l_quantity > 10")
        drain(lines.agg(F.sum("l_extendedprice")))

    def pick(path: str) -> None:
        some = read_raw(spark, path).filter("l_partkey between 100 and 120")
        drain(some.agg(F.sum("l_extendedprice")))

    def join(hint: str) -> None:
        drain(joins.attach_daily_total(silver, daily, hint=hint))

    def fresh(name: str) -> None:
        drain(QUERIES[name](spark, FOLDER))

    actions = {
        "unpruned_avg": lambda: drain(day_average(whole)),
        "pruned_avg": lambda: drain(day_average(by_day)),
        "two_aggregates_uncached": lambda: two_aggregates(silver),
        "two_aggregates_cached": with_cache,
        "join_sort_merge": lambda: join("merge"),
        "join_broadcast": lambda: join("broadcast"),
        "scan_fragmented": lambda: scan(fragments),
        "scan_compacted": lambda: scan(compacted),
        "filter_unordered": lambda: pick(unordered),
        "filter_zordered": lambda: pick(clustered),
        "upsert": lambda: fresh("merge_upsert"),
        "window_stream": lambda: fresh("stream_window_counts"),
    }
    times = {}
    for name, action in actions.items():
        action()
        times[name] = seconds(action, 5)
    return times


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        {
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    try:
        result = pairs(spark) if sys.argv[1:] == ["pairs"] else all_queries(spark)
        print(json.dumps(result))
    finally:
        release(spark)
        spark.stop()


if __name__ == "__main__":
    main()
