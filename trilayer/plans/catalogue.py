"""Every query by name: (session, folder of input tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trilayer.functions import privacy
from trilayer.functions.exact import is_finite, rounded_sum
from trilayer.functions.times import add_time_partitions, without_zone
from trilayer.operators import (
    anonymity,
    asof,
    cleanse,
    declared,
    file_index,
    gold,
    hash_tree,
    history,
    joins,
    layout,
    merge,
    overlap,
    ranged,
    sketches,
    versions,
)
from trilayer.operators.quality import apply_rules, observe_rules
from trilayer.operators.quality import rule_metrics as metrics_of
from trilayer.operators.reconcile import copy_verified, reconcile
from trilayer.plans import examples
from trilayer.plans.layers import (
    bronze_table,
    build_bronze,
    gold_daily_table,
    named_layer,
    silver_table,
)
from trilayer.session import bound_tasks
from trilayer.sources.raw import (
    file_stream_location,
    infer_or_load_schema,
    read_raw,
    stream_files,
    stream_table,
    table,
)
from trilayer.sources.trips import parse_events, raw_trips, shape_trips
from trilayer.sources.writers import (
    append_checked,
    append_evolving,
    read_evolved,
    write_layer,
)
from trilayer.streaming import drift, sessions
from trilayer.streaming import trips as streams
from trilayer.streaming.runner import read_complete, run_stream
from trilayer.workspace import new_dir, written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SALT = "pepper-and-salt"
SECRET = "vault-key"


def query(function: Query) -> Query:
    """Register a query; it runs in UTC, with tasks of bounded shuffled bytes, and returns
    wall-clock timestamps."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        bound_tasks(spark)
        return without_zone(function(spark, folder))

    run.__doc__ = function.__doc__
    run.__name__ = function.__name__
    QUERIES[function.__name__] = run
    return run


# Layers


@query
def bronze_ingest(spark, folder):
    """Raw trips with time partitions, written partitioned and read back."""
    path = new_dir(spark, "bronze_ingest")
    bronze = build_bronze(spark, folder)
    write_layer(bronze, path, partition_by=["pickup_year", "pickup_month"], rebalance=True)
    return read_raw(spark, path, schema=bronze.schema).drop("ingestion_timestamp", "source_file")


@query
def bronze_partitions(spark, folder):
    """The partitions of the bronze table, with their rows."""
    parts = gold.rows_per(bronze_table(spark, folder), "pickup_year", "pickup_month")
    return parts.withColumnRenamed("count", "partition_rows")


@query
def silver_cleanse(spark, folder):
    return cleanse.cleanse(add_time_partitions(raw_trips(spark, folder)))


@query
def silver_rejects(spark, folder):
    """Rows that break each validity rule."""
    return cleanse.reject_counts(raw_trips(spark, folder))


@query
def reject_reasons(spark, folder):
    """Each rejected trip with the rules it breaks."""
    return cleanse.rejects(raw_trips(spark, folder)).select(
        "event_id", F.array_join("failed_rules", ",").alias("failed_rules")
    )


@query
def silver_enrich(spark, folder):
    return cleanse.silver(raw_trips(spark, folder)).select(
        "event_id", "trip_duration_seconds", "trip_duration_minutes", "average_speed_mph"
    )


@query
def layer_counts(spark, folder):
    return cleanse.layer_counts(raw_trips(spark, folder))


@query
def reconcile_layers(spark, folder):
    """An independent copy of the silver table, compared with it."""
    silver = silver_table(spark, folder)
    return reconcile(silver, copy_verified(silver, new_dir(spark, "silver_copy")))


@query
def reconcile_differences(spark, folder):
    """Orders against copies that differ: in one row, in nulls that trade places, in
    nothing."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("F")).alias("a"),
        F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("b"),
    )
    smallest = orders.agg(F.min("o_orderkey")).first()[0]
    copies = {
        "changed_row": orders.withColumn(
            "a", F.when(F.col("o_orderkey") == smallest, "?").otherwise(F.col("a"))),
        "same": orders.repartition(3),
        "swapped_nulls": orders.select("o_orderkey", F.col("b").alias("a"), F.col("a").alias("b")),
    }
    found = [
        reconcile(orders, copy).select(F.lit(name).alias("copy"), "*")
        for name, copy in copies.items()
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query
def reconcile_rows(spark, folder):
    """Orders against a copy with changed, missing, additional and repeated rows: which
    keys differ, and how."""
    orders = table(spark, folder, "orders")
    copy = orders.filter("o_orderkey % 100 <> 1").withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") % 100 == 2, F.col("o_totalprice") + 1).otherwise(
            F.col("o_totalprice")))
    more = orders.filter("o_orderkey % 100 = 3").withColumn("o_orderkey", -F.col("o_orderkey"))
    again = orders.filter("o_orderkey % 100 = 4")
    copy = copy.unionByName(more).unionByName(again)
    return hash_tree.row_differences(orders, copy, ["o_orderkey"])


@query
def gold_daily_summary(spark, folder):
    """Raw events to trips to silver to gold in one plan."""
    silver = cleanse.silver(raw_trips(spark, folder))
    return gold.daily_summary(silver).orderBy("trip_date")


@query
def gold_zone_summary(spark, folder):
    silver = cleanse.silver(add_time_partitions(raw_trips(spark, folder)))
    return gold.zone_order(gold.zone_summary(silver))


# Declared datasets with rules


@query
def declared_silver(spark, folder):
    return declared.declared_silver(raw_trips(spark, folder))


@query
def declared_daily_summary(spark, folder):
    return declared.declared_gold(declared.declared_silver(raw_trips(spark, folder)))


@query
def rule_metrics(spark, folder):
    """Rows that pass and break each rule, before any filter."""
    return metrics_of(declared.shape_silver(raw_trips(spark, folder)), declared.RULES)


# Reads of the silver table


@query
def pruned_avg(spark, folder):
    """Average tip per zone in one month; other partitions are not read."""
    return spark.sql(
        """
        SELECT pickup_location_id,
               CASE WHEN count_if(isnan(tip_amount) OR abs(tip_amount) = double('Infinity')) > 0
                    THEN avg(tip_amount)
                    ELSE try_divide(
                      CAST(sum(CAST(CASE WHEN NOT isnan(tip_amount)
                                          AND abs(tip_amount) < double('Infinity')
                                         THEN tip_amount END AS DECIMAL(28, 10))) AS DOUBLE),
                      count(tip_amount)) END AS avg_tip
        FROM {silver} WHERE pickup_year = 2024 AND pickup_month = 1
        GROUP BY pickup_location_id ORDER BY pickup_location_id
        """,
        silver=silver_table(spark, folder),
    )


def silver_by_day(spark, folder):
    """The silver table written once more, one partition per day of pickup."""
    path = new_dir(spark, "silver_by_day")
    by_day = silver_table(spark, folder).withColumn(
        "pickup_day", F.dayofmonth("tpep_pickup_datetime"))
    write_layer(by_day, path, partition_by=["pickup_day"], rebalance=True)
    return read_raw(spark, path, schema=by_day.schema)


@query
def pruned_days(spark, folder):
    """Average tip per zone over three days of the month; other days are not read."""
    days = silver_by_day(spark, folder).filter("pickup_day BETWEEN 5 AND 7")
    return gold.average_per(days, ["pickup_day", "pickup_location_id"], "tip_amount", "avg_tip")


@query
def filtered_avg(spark, folder):
    """Average tip per zone over high tips; the filter reaches the scan."""
    high = silver_table(spark, folder).filter("tip_amount > 50")
    return gold.average_per(high, ["pickup_location_id"], "tip_amount", "avg_tip").orderBy(
        "pickup_location_id"
    )


@query
def long_trips(spark, folder):
    return (
        silver_table(spark, folder)
        .filter("pickup_year = 2024 AND pickup_month = 1 AND trip_distance > 10")
        .select("event_id", "tpep_pickup_datetime", "trip_distance", "total_amount")
    )


@query
def avg_fare_by_passengers(spark, folder):
    return gold.average_per(
        silver_table(spark, folder), ["passenger_count"], "fare_amount", "avg_fare"
    )


@query
def trips_by_vendor(spark, folder):
    return gold.rows_per(silver_table(spark, folder), "vendor_id").withColumnRenamed(
        "count", "trips"
    )


@query
def earliest_trips(spark, folder):
    """A preview of ten rows in a stated order."""
    chosen = silver_table(spark, folder).select(
        "event_id", "tpep_pickup_datetime", "pickup_location_id", "total_amount"
    )
    return gold.first_rows(chosen, 10, "tpep_pickup_datetime", "event_id")


@query
def silver_by_name(spark, folder):
    """Trips per vendor and month from the silver table, read by its name in the catalog."""
    name = named_layer(spark, folder, "silver", "Valid trips")
    counts = gold.rows_per(spark.table(name), "pickup_year", "pickup_month", "vendor_id")
    return counts.withColumnRenamed("count", "trips")


@query
def running_totals(spark, folder):
    """Each trip with its zone's trips, takings and highest fare so far."""
    silver = silver_table(spark, folder).select(
        "event_id", "pickup_location_id", "tpep_pickup_datetime", "total_amount", "fare_amount"
    )
    totals = {
        "trips_so_far": ("count", "event_id"), "taken_so_far": ("sum", "total_amount"),
        "highest_fare": ("max", "fare_amount"), "lowest_fare": ("min", "fare_amount"),
    }
    order = ["tpep_pickup_datetime", "event_id"]
    return ranged.running(silver, ["pickup_location_id"], order, totals)


@query
def gold_sketches(spark, folder):
    """Trips, distinct zones, median and 95th percentile of takings per day, month and in
    all, the longer periods merged from the days' sketches; and whether the estimates are
    within their stated errors of the true figures."""
    silver = silver_table(spark, folder)
    days = written(
        sketches.daily_sketches(silver, ["pickup_location_id"], ["total_amount"]), "sketches")
    months = sketches.merged(days, F.date_trunc("month", "trip_date"))
    never = F.lit(None).cast("timestamp")
    periods = {
        "day": (days.withColumnRenamed("trip_date", "period"), gold.day()),
        "month": (months, F.date_trunc("month", "tpep_pickup_datetime")),
        "all": (sketches.merged(months.withColumnRenamed("period", "trip_date"), never), never),
    }
    found = [
        _sketch_errors(silver, kept, period, level == "all").select(F.lit(level).alias("level"), "*")
        for level, (kept, period) in periods.items()
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


def _sketch_errors(silver, kept, period, whole):
    """Estimates of each period and whether they are within their errors."""
    told = kept.select(
        "period", "trips", sketches.distinct_estimate("pickup_location_id").alias("zones_told"),
        sketches.quantile_estimate("total_amount", 0.5).alias("p50"),
        sketches.quantile_estimate("total_amount", 0.95).alias("p95"),
    )
    amount = F.when(is_finite(F.col("total_amount")), F.col("total_amount"))
    rows = silver.select(period.alias("_period"), "pickup_location_id", amount.alias("amount"))
    if whole:  # one row, which needs no join
        told = written(told, "sketch-estimates")
        joined = rows.withColumns({name: told.select(name).scalar() for name in told.columns})
    else:
        joined = rows.join(joins.broadcast_if_small(told), F.col("_period") == F.col("period"))

    def ranks(name, rank):
        below = F.count_if(F.col("amount") < F.col(name)) / F.count("amount")
        upto = F.count_if(F.col("amount") <= F.col(name)) / F.count("amount")
        return (below <= rank + sketches.RANK_ERROR) & (upto >= rank - sketches.RANK_ERROR)

    zones = F.count_distinct("pickup_location_id")
    return joined.groupBy("period", "trips", "zones_told").agg(
        zones.alias("zones"), ranks("p50", 0.5).alias("median_close"),
        ranks("p95", 0.95).alias("p95_close"),
    ).select(
        "period", "trips", "zones",
        (F.abs(F.col("zones_told") - F.col("zones")) <= F.ceil(
            F.col("zones") * sketches.DISTINCT_ERROR)).alias("zones_close"),
        "median_close", "p95_close",
    )


# Joins


@query
def asof_join(spark, folder):
    """Each event with the price and key of its user's newest order at that time; order
    dates are folded into the month of the events."""
    events = table(spark, folder, "events").select("event_id", "user_id", "ts")
    second = F.pmod(F.unix_date(F.to_date("o_orderdate")) * 3671 + F.col("o_orderkey") * 61, F.lit(2_592_000))
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("user_id"), "o_totalprice", "o_orderkey",
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=second)).alias("ordered_at"),
    )
    return asof.asof_join(
        events, orders, ["user_id"], "ts", "ordered_at", ["o_totalprice", "o_orderkey"])


@query
def overlap_join(spark, folder):
    """Pairs of trips to one zone that were under way at the same time."""
    start, end = "tpep_pickup_datetime", "tpep_dropoff_datetime"
    trips = silver_table(spark, folder).select("dropoff_location_id", "event_id", start, end)
    others = trips.withColumnsRenamed(
        {name: f"other_{name}" for name in ("event_id", start, end)})
    pairs = overlap.overlap_join(
        trips, others, (start, end), (f"other_{start}", f"other_{end}"), ["dropoff_location_id"],
        columns=["dropoff_location_id", "event_id", "other_event_id"])
    return pairs.filter("event_id < other_event_id")


TRIP_AND_DAY = [
    "event_id",
    "tpep_pickup_datetime",
    "pickup_location_id",
    "total_amount",
]


def _trips_where(spark, folder, condition):
    return silver_table(spark, folder).filter(condition).select(*TRIP_AND_DAY)


@query
def join_daily_total(spark, folder):
    """Each well-tipped trip with its day's total; the optimizer picks the join."""
    trips = _trips_where(spark, folder, "tip_amount > 10")
    return joins.attach_daily_total(
        trips, gold_daily_table(spark, folder), "trips_on_pickup_day"
    )


@query
def join_daily_broadcast_sql(spark, folder):
    trips = _trips_where(spark, folder, "passenger_count = 1")
    return joins.attach_daily_total_sql(trips, gold_daily_table(spark, folder))


@query
def join_daily_broadcast_df(spark, folder):
    trips = _trips_where(spark, folder, "passenger_count = 2")
    return joins.attach_daily_total(
        trips, gold_daily_table(spark, folder), hint="broadcast"
    )


@query
def zone_names(spark, folder):
    """Customers per nation and region name; counted per key before names are joined."""
    counts = gold.rows_per(table(spark, folder, "customer"), "c_nationkey")
    nations = joins.lookup_names(
        counts,
        table(spark, folder, "nation"),
        {"c_nationkey": "n_nationkey"},
        {"n_name": "nation", "n_regionkey": "n_regionkey"},
    )
    named = joins.lookup_names(
        nations,
        table(spark, folder, "region"),
        {"n_regionkey": "r_regionkey"},
        {"r_name": "region"},
    )
    return named.groupBy("nation", "region").agg(F.sum("count").alias("customers"))


# Upserts


@query
def union_by_name(spark, folder):
    """The merge source for trips; columns that one part lacks are null."""
    return examples.trip_changes(silver_table(spark, folder).drop("source_file"))


@query
def merge_upsert(spark, folder):
    orders = table(spark, folder, "orders")
    return merge.merge_upsert(
        orders,
        written(examples.order_changes(orders), "order_changes"),
        ["o_orderkey"],
        [examples.ORDER_UPDATE, examples.ORDER_INSERT],
    )


def _order_merge(spark, folder):
    orders = table(spark, folder, "orders")
    return merge.merge_actions(
        orders,
        written(examples.order_changes(orders), "order_changes"),
        ["o_orderkey"],
        [examples.ORDER_UPDATE, examples.ORDER_DELETE, examples.ORDER_INSERT],
    )


@query
def merge_delete(spark, folder):
    """The upsert with its delete clause as well."""
    return _order_merge(spark, folder).filter("merge_action <> 'delete'").drop("merge_action")


@query
def merge_metrics(spark, folder):
    return merge.merge_metrics(_order_merge(spark, folder))


@query
def merge_repeated_keys(spark, folder):
    """A merge whose source repeats keys without conflict: an update and an insertion of
    one key, and two insertions of a new one."""
    orders = table(spark, folder, "orders")
    changes = examples.order_changes(orders)
    updates = changes.filter("merge_operation = 'UPDATE'")
    inserts = changes.filter("merge_operation = 'INSERT'")
    source = changes.unionByName(
        updates.withColumn("merge_operation", F.lit("INSERT"))
    ).unionByName(inserts.withColumn("o_totalprice", F.col("o_totalprice") + 1))
    return merge.merge_upsert(
        orders,
        written(source, "repeated_changes"),
        ["o_orderkey"],
        [examples.ORDER_UPDATE, examples.ORDER_INSERT],
    )


@query
def merge_artifacts(spark, folder):
    """Rows that a merge by five key columns has changed or brought in."""
    silver = silver_table(spark, folder)
    merged = merge.merge_upsert(
        silver.withColumn("data_source_quality", F.lit(None).cast("string")),
        written(examples.trip_changes(silver), "trip_changes"),
        examples.TRIP_KEY,
        [examples.TRIP_UPDATE, examples.TRIP_INSERT],
        dedupe_by=["event_id"],
    )
    return merged.filter(
        "data_source_quality = 'Updated Tip' OR tip_amount = 8.88 OR tip_amount = 4.44"
    ).select(
        "event_id",
        "tpep_pickup_datetime",
        "pickup_location_id",
        "tip_amount",
        "total_amount",
        "trip_duration_minutes",
        "data_source_quality",
    )


# Versions


def _log(spark, folder):
    return examples.order_log(table(spark, folder, "orders"))


@query
def change_history(spark, folder):
    return versions.change_history(_log(spark, folder))


@query
def as_of_version(spark, folder):
    return versions.state_as_of(
        _log(spark, folder), ["o_orderkey"], examples.ORDER_VALUES, version=1
    )


@query
def as_of_timestamp(spark, folder):
    return versions.state_as_of(
        _log(spark, folder),
        ["o_orderkey"],
        examples.ORDER_VALUES,
        timestamp="2024-01-01 00:30:00",
    )


@query
def version_before_merge(spark, folder):
    return versions.version_before(_log(spark, folder))


@query
def restore_version(spark, folder):
    """State after the changes that undo the merge are added to the log."""
    log = _log(spark, folder)
    undo = versions.revert_changes(
        log,
        ["o_orderkey"],
        examples.ORDER_VALUES,
        version=1,
        commit_ts=F.lit("2024-01-01 03:00:00").cast("timestamp_ntz"),
    )
    return versions.state_as_of(
        log.unionByName(undo), ["o_orderkey"], examples.ORDER_VALUES
    )


@query
def restore_timestamp(spark, folder):
    """State after a return to how the table stood at a time between two commits."""
    log = written(_log(spark, folder), "order_log")
    undo = versions.revert_changes(
        log, ["o_orderkey"], examples.ORDER_VALUES, timestamp="2024-01-01 01:30:00",
        commit_ts=F.lit("2024-01-01 03:00:00").cast("timestamp_ntz"),
    )
    return versions.state_as_of(log.unionByName(undo), ["o_orderkey"], examples.ORDER_VALUES)


@query
def checked_append(spark, folder):
    """Orders per status after a second batch of the same schema was appended."""
    orders = table(spark, folder, "orders")
    path = new_dir(spark, "appended")
    write_layer(orders, path)
    append_checked(orders.filter("o_orderpriority = '2-HIGH'"), path)
    return gold.rows_per(read_raw(spark, path), "o_orderstatus").withColumnRenamed(
        "count", "orders"
    )


@query
def schema_evolution(spark, folder):
    """Rows per quality flag after an append that brought the flag column."""
    orders = table(spark, folder, "orders")
    path = new_dir(spark, "evolving")
    write_layer(orders, path)
    flagged = orders.filter("o_orderpriority = '1-URGENT'").withColumn(
        "data_source_quality", F.lit("Good")
    )
    schema = append_evolving(flagged, path, schema=orders.schema)
    return (
        read_evolved(spark, path, schema)
        .groupBy("data_source_quality")
        .agg(
            F.count("*").alias("orders"),
            rounded_sum("o_totalprice").alias("total_price"),
        )
    )


@query
def as_of_interval(spark, folder):
    """The state at a version from a history of intervals that a later commit has been
    brought into; one filter, which skips what had ended by then."""
    log = written(_log(spark, folder), "order_log")
    keys, path = ["o_orderkey"], new_dir(spark, "history")
    found = history.intervals(log.filter("version < 2"), keys, examples.ORDER_VALUES)
    schema = history.write_history(found, path, keys)
    history.commit(
        spark, path, schema, keys, examples.ORDER_VALUES, log.filter("version = 2"), 2,
        "2024-01-01 02:00:00",
    )
    return history.as_of(history.read_history(spark, path, schema), version=1)


# File layout


def _line_totals(lines):
    return lines.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("lines"),
        rounded_sum("l_quantity").alias("quantity"),
        rounded_sum("l_extendedprice").alias("price"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
    )


# Rows of a table that one task lays out, and of which one small file is made.
PIECE_ROWS = 2_000_000
FRAGMENT_ROWS = 400_000


def _pieces(rows, least, rows_per_piece=None):
    """Parts to write a table in: ``least``, and more if it has many rows."""
    return max(least, -(-rows.count() // (rows_per_piece or PIECE_ROWS)))


def _file_bytes(spark, path, files):
    """A file size that gives a small table this many files; large ones get full files."""
    return min(layout.FILE_BYTES, max(1, layout.table_bytes(spark, path) // files))


@query
def compact_rows(spark, folder):
    """Totals of a table that was written in many files and then compacted."""
    fragments, compacted = new_dir(spark, "fragments"), new_dir(spark, "compacted")
    write_layer(table(spark, folder, "lineitem").repartition(64), fragments)
    size = _file_bytes(spark, fragments, 8)
    return _line_totals(layout.compact(spark, fragments, compacted, file_bytes=size))


def _zordered(spark, folder):
    source, path = f"{folder}/lineitem.parquet", new_dir(spark, "zordered")
    size = _file_bytes(spark, source, 16)
    layout.zorder_layout(spark, source, path, ["l_partkey", "l_shipdate"], size)
    return path


@query
def zorder_rows(spark, folder):
    """Totals of a table after clustering by two columns."""
    return _line_totals(read_raw(spark, _zordered(spark, folder)))


@query
def compact_small(spark, folder):
    """Totals of a table of a large file (or several, if it has many rows) and many small
    ones, after only the small ones were packed into larger files."""
    lines, path = table(spark, folder, "lineitem"), new_dir(spark, "mixed-sizes")
    large, small = lines.filter("l_linenumber < 4"), lines.filter("l_linenumber >= 4")
    write_layer(large.repartition(_pieces(lines, 1)), path)
    write_layer(small.repartition(_pieces(lines, 40, FRAGMENT_ROWS)), path, "append")
    largest = layout.list_files(spark, path).agg(F.max("length")).first()[0] or 1
    found, _ = layout.compact_small(
        spark, path, new_dir(spark, "packed"), lines.schema, file_bytes=largest)
    return _line_totals(found)


@query
def indexed_read(spark, folder):
    """Totals of a few parts' lines, from the files that an index of lowest and highest
    values and Bloom filters chooses; the index was made in two steps."""
    source = f"{folder}/lineitem.parquet"
    path, schema = _zordered(spark, folder), read_raw(spark, source).schema
    first = file_index.index_files(spark, path, ["l_partkey"], ["l_orderkey"], schema=schema)
    write_layer(read_raw(spark, source).filter("l_partkey = 7"), path, "append")
    index = file_index.index_files(
        spark, path, ["l_partkey"], ["l_orderkey"], known=first, schema=schema)
    return _line_totals(file_index.indexed_read(spark, path, schema, index, {"l_partkey": (0, 50)}))


def _in_files(rows, files):
    """``rows``, a scan, in this many parts that all have rows if there are enough. Rows are
    shuffled only where the scan's own partitions are too few or some of them empty."""
    scan = rows.rdd.getNumPartitions()
    if files <= scan == rows.select(F.spark_partition_id()).distinct().count():
        return rows.coalesce(files)
    return rows.repartition(files)


@query
def file_profile(spark, folder):
    """A table written in eight files: rows of all files, and whether sizes agree with
    the file listing."""
    path, lines = new_dir(spark, "profiled"), table(spark, folder, "lineitem")
    write_layer(_in_files(lines, 8), path)
    profile = layout.file_profile(spark, path)
    listed = layout.table_bytes(spark, path)
    return profile.agg(
        F.count("*").alias("files"),
        F.sum("rows").alias("rows"),
        (F.sum("bytes") == listed).alias("sizes_agree"),
        (F.min("rows") > 0).alias("all_have_rows"),
    )


@query
def skipping_report(spark, folder):
    """Files that a range on one clustered column has to read, in figures that do not
    depend on the layout."""
    path = _zordered(spark, folder)
    wanted = read_raw(spark, path).filter("l_partkey BETWEEN 0 AND 50")
    report = layout.skipping_report(spark, path, {"l_partkey": (0, 50)})
    report = report.withColumn("matching_rows", wanted.select(F.count("*")).scalar())
    return report.select(
        "rows", "matching_rows",
        (F.col("files_read") + F.col("files_skipped") == F.col("files")).alias("files_add_up"),
        F.col("rows_read").between(F.col("matching_rows"), F.col("rows")).alias("reads_enough"),
        (F.col("files_skipped") > 0).alias("skips_some"),
    )


@query
def compact_partitions(spark, folder):
    """Rows per ship year after only the partitions of one year were compacted."""
    lines = table(spark, folder, "lineitem").withColumn("ship_year", F.year("l_shipdate"))
    source, done = new_dir(spark, "by_year"), new_dir(spark, "by_year_compacted")
    write_layer(lines.repartition(_pieces(lines, 4)), source, partition_by=["ship_year"])
    found = layout.compact(
        spark, source, done, ["ship_year"], where="ship_year = 1995", schema=lines.schema)
    return found.groupBy("ship_year").agg(
        F.count("*").alias("lines"), rounded_sum("l_quantity").alias("quantity"))


# Streams


# Files that one micro-batch takes, so that a backlog is read in steps.
FILES_PER_BATCH = 64


def _streamed_bronze(spark, folder):
    """Ingest the events as a stream; returns the path of the bronze table."""
    source, glob = file_stream_location(spark, f"{folder}/events.parquet")
    run = new_dir(spark, "stream")
    schema = infer_or_load_schema(spark, source, f"{run}/schema", glob)
    events = streams.with_stream_metadata(
        stream_files(spark, source, schema, glob, FILES_PER_BATCH))
    run_stream(
        streams.bronze_stream(shape_trips(parse_events(events))),
        checkpoint=f"{run}/bronze_checkpoint",
        path=f"{run}/bronze",
        name="trips_bronze",
    )
    return run


@query
def stream_bronze(spark, folder):
    run = _streamed_bronze(spark, folder)
    return read_raw(spark, f"{run}/bronze").drop(
        "streaming_ingestion_timestamp", "streaming_source_file"
    )


def _second_stream(spark, run):
    schema = read_raw(spark, f"{run}/bronze").schema
    bronze = stream_files(spark, f"{run}/bronze", schema, max_files_per_trigger=FILES_PER_BATCH)
    return streams.window_counts(bronze)


def _closed_windows(spark, folder):
    run = _streamed_bronze(spark, folder)
    run_stream(
        _second_stream(spark, run),
        checkpoint=f"{run}/windows_checkpoint",
        path=f"{run}/windows",
        name="trips_windows",
    )
    return streams.flat_windows(read_raw(spark, f"{run}/windows"))


@query
def stream_window_counts(spark, folder):
    """Windows that the watermark has closed, each emitted once."""
    return _closed_windows(spark, folder)


@query
def stream_window_counts_update(spark, folder):
    """All windows, by their newest count."""
    run = _streamed_bronze(spark, folder)
    run_stream(
        _second_stream(spark, run),
        checkpoint=f"{run}/updates_checkpoint",
        path=f"{run}/updates",
        name="trips_window_updates",
        mode="update",
    )
    return streams.flat_windows(streams.read_updates(spark, f"{run}/updates"))


@query
def stream_window_counts_complete(spark, folder):
    """All windows, written as a whole with every micro-batch."""
    run = _streamed_bronze(spark, folder)
    run_stream(
        _second_stream(spark, run),
        checkpoint=f"{run}/complete_checkpoint",
        path=f"{run}/complete",
        name="trips_windows_complete",
        mode="complete",
    )
    return streams.flat_windows(read_complete(spark, f"{run}/complete"))


STREAM_RULES = declared.RULES[:3]


@query
def stream_rules(spark, folder):
    """Rows that a stream under row rules lets through."""
    run = _streamed_bronze(spark, folder)
    schema = read_raw(spark, f"{run}/bronze").schema
    bronze = stream_files(spark, f"{run}/bronze", schema, max_files_per_trigger=FILES_PER_BATCH)
    checked = apply_rules(observe_rules(bronze, STREAM_RULES), STREAM_RULES)
    run_stream(
        checked.select("event_id", "tpep_pickup_datetime", "trip_distance", "fare_amount"),
        checkpoint=f"{run}/rules_checkpoint",
        path=f"{run}/silver",
        name="trips_rules",
    )
    return read_raw(spark, f"{run}/silver")


# Trips of one landed file, and files at least, so that a stream has several batches.
LANDED_ROWS = 1_000_000
LANDED_FILES = 4


# Rows of a micro-batch for each part of a stream's state.
STATE_ROWS = 100_000


def _state_partitions(spark, rows=LANDED_ROWS):
    """Parts of the state of a stream that takes landed files one at a time. Each part is
    saved with every micro-batch, so their number goes by the rows of a file and not by
    the size of the whole input, as the session's shuffle partitions do."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(1, rows // STATE_ROWS))


def _landed(spark, rows, time, twice=None, rows_per_file=LANDED_ROWS, files=LANDED_FILES):
    """Events or trips landed one file after the other in the order of time, those without
    a time first. Files hold equal numbers of rows, however these lie in time; rows that
    meet the condition ``twice`` come twice in their file. Also returns their schema."""
    path, staged = new_dir(spark, "landed"), new_dir(spark, "landing_order")
    rows = written(rows, "landing")
    files = max(files, -(-rows.count() // rows_per_file))
    ordered = rows.repartitionByRange(files, time, "event_id")
    write_layer(ordered.withColumn("_file", F.spark_partition_id()), staged, partition_by=["_file"])
    whole = T.StructType([*rows.schema, T.StructField("_file", T.IntegerType())])
    parts = read_raw(spark, staged, schema=whole)
    for number in range(files):
        part = parts.filter(F.col("_file") == number).drop("_file")
        if twice:
            part = part.unionByName(part.filter(twice)).coalesce(1)
        write_layer(part, path, "append")
    return path, rows.schema


def _landed_trips(spark, folder):
    return _landed(spark, raw_trips(spark, folder), "tpep_pickup_datetime")


@query
def stream_by_table(spark, folder):
    """Windows of all micro-batches: files of trips are streamed one at a time into a named
    table, which a second stream reads by its name. Both event times are cast."""
    run = new_dir(spark, "by_table")
    landed, schema = _landed_trips(spark, folder)
    name = f"stream_bronze_{run.rpartition('-')[2]}"
    run_stream(
        streams.bronze_stream(stream_files(spark, landed, schema, max_files_per_trigger=1)),
        checkpoint=f"{run}/bronze_checkpoint", path=f"{run}/bronze", table=name,
    )
    longer = stream_table(spark, name, 1).filter("tpep_dropoff_datetime > tpep_pickup_datetime")
    run_stream(
        streams.window_counts(longer), checkpoint=f"{run}/windows_checkpoint",
        path=f"{run}/windows", mode="update", state_partitions=_state_partitions(spark),
    )
    spark.sql(f"DROP TABLE {name}")  # the files stay
    return streams.flat_windows(streams.read_updates(spark, f"{run}/windows"))


@query
def declared_stream(spark, folder):
    """The declared datasets as a chain of streams: silver under its rules, then gold as a
    whole with every micro-batch; files are taken one at a time."""
    run = new_dir(spark, "declared")
    landed, schema = _landed_trips(spark, folder)
    checked = declared.declared_silver(stream_files(spark, landed, schema, max_files_per_trigger=1))
    run_stream(
        checked, checkpoint=f"{run}/silver_checkpoint", path=f"{run}/silver",
        name="declared_silver",
    )
    silver = stream_files(spark, f"{run}/silver", checked.schema, max_files_per_trigger=1)
    run_stream(
        declared.declared_gold(silver), checkpoint=f"{run}/gold_checkpoint",
        path=f"{run}/gold", name="declared_gold", mode="complete",
        state_partitions=_state_partitions(spark),
    )
    return read_complete(spark, f"{run}/gold")


def _landed_events(spark, folder, twice=None):
    events = table(spark, folder, "events").drop("props")
    return _landed(spark, events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", twice)


@query
def stream_join(spark, folder):
    """Views and the purchases of the same user within half an hour, from two streams over
    several micro-batches."""
    run, (landed, schema) = new_dir(spark, "stream-join"), _landed_events(spark, folder)
    events = stream_files(spark, landed, schema, max_files_per_trigger=1)
    views = events.filter("event_type = 'view'").select("user_id", "event_id", "ts")
    bought = events.filter("event_type = 'purchase'").select(
        "user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts"), "value")
    joined = sessions.interval_join(
        views, bought, ["user_id"], "ts", "purchase_ts", "30 minutes", "20 minutes", "20 minutes")
    run_stream(
        joined, checkpoint=f"{run}/checkpoint", path=f"{run}/pairs", name="views_purchases",
        state_partitions=_state_partitions(spark),
    )
    return read_raw(spark, f"{run}/pairs", schema=joined.schema)


@query
def stream_sessions(spark, folder):
    """Closed sessions of each user with breaks of an hour, from a stream that brings some
    events twice."""
    run, (landed, schema) = new_dir(spark, "sessions"), _landed_events(spark, folder, "event_id % 10 = 0")
    events = stream_files(spark, landed, schema, max_files_per_trigger=1)
    found = sessions.sessions(events, "user_id", "ts", "1 hour", ["event_id"], "20 minutes")
    run_stream(
        found, checkpoint=f"{run}/checkpoint", path=f"{run}/sessions", name="user_sessions",
        state_partitions=_state_partitions(spark),
    )
    return read_raw(spark, f"{run}/sessions", schema=found.schema)


def _drifting_events(spark, folder):
    """Events that land in three steps: as they are, then with a channel, then with the
    user as text that is mostly, not always, a number."""
    source = new_dir(spark, "drifting")
    events = written(table(spark, folder, "events").drop("props"), "drifting-events")
    channel = F.concat(F.lit("c"), F.col("event_id") % 4)
    user = F.col("user_id").cast("string")
    named = F.when(F.col("event_type") == "view", F.concat(F.lit("u"), user)).otherwise(user)
    steps = [
        events,
        events.withColumn("channel", channel),
        events.withColumn("channel", channel).withColumn("user_id", named),
    ]
    for number, step in enumerate(steps):
        write_layer(step.filter(F.col("event_id") % 3 == number), source, "append")
    return source


def _drifted(spark, folder, evolve):
    run, source = new_dir(spark, "drift"), _drifting_events(spark, folder)
    schema = table(spark, folder, "events").drop("props").schema
    drift.ingest_drifting(
        spark, source, f"{run}/bronze", f"{run}/checkpoint", evolve, schema,
        max_files_per_trigger=FILES_PER_BATCH,
    )
    rows = drift.read_drifted(spark, f"{run}/bronze", f"{run}/checkpoint")
    return rows.withColumn("rescued_user", F.try_element_at("_rescued", F.lit("user_id")))


@query
def stream_drift(spark, folder):
    """A stream under a fixed schema; an unknown field and users that are no number are
    rescued."""
    return _drifted(spark, folder, False).withColumn(
        "rescued_channel", F.try_element_at("_rescued", F.lit("channel"))
    ).drop("_rescued")


@query
def stream_evolved(spark, folder):
    """The same stream with a schema that grows by the new field."""
    return _drifted(spark, folder, True).drop("_rescued")


@query
def first_windows(spark, folder):
    """The ten earliest closed windows."""
    return gold.first_rows(
        _closed_windows(spark, folder), 10, "window_start", "pickup_location_id"
    )


# Personal data


def _emails(spark, folder):
    return privacy.extract_matches(
        table(spark, folder, "documents"),
        ["doc_id"],
        "text",
        privacy.EMAIL,
        privacy.EMAIL_PART,
        "email",
    )


@query
def pii_hash(spark, folder):
    return _emails(spark, folder).select(
        "doc_id",
        "position",
        privacy.hash_pii(F.col("email")).alias("email_hash"),
        privacy.hash_pii(F.col("email"), SALT).alias("email_hash_salted"),
    )


@query
def pii_mask(spark, folder):
    """Masked e-mail addresses and phone numbers, wherever they stand in the texts."""
    documents = table(spark, folder, "documents")
    emails = privacy.matches("text", privacy.EMAIL, privacy.EMAIL_PART)
    phones = privacy.matches("text", privacy.PHONE)

    def labelled(kind, values, mask):
        return F.transform(
            F.coalesce(values, F.array().cast("array<string>")),
            lambda value, at: F.struct(
                F.lit(kind).alias("kind"), at.alias("position"), mask(value).alias("masked")
            ),
        )

    found = F.concat(
        labelled("email", emails, privacy.mask_email),
        labelled("phone", phones, privacy.mask_phone),
    )
    return documents.select("doc_id", F.inline(found))


@query
def pii_tokenize(spark, folder):
    """Rows per token."""
    tokens = privacy.tokenize(_emails(spark, folder), "email", SECRET)
    return gold.rows_per(tokens, "token").withColumnRenamed("count", "token_rows")


@query
def pii_vault(spark, folder):
    """Rows per token when a vault made with an older key knows some of the addresses."""
    emails = _emails(spark, folder).select("doc_id", "email")
    vault = privacy.new_vault_rows(emails.filter("doc_id % 2 = 0"), "email", "older-key")
    vault = written(vault, "vault")
    fresh = written(privacy.new_vault_rows(emails, "email", SECRET, vault), "vault_rows")
    tokens = privacy.tokenize(emails, "email", SECRET, vault.unionByName(fresh))
    return gold.rows_per(tokens, "token").withColumnRenamed("count", "token_rows")


@query
def pii_generalise(spark, folder):
    """Account balance as a range per customer, hidden where few customers share it."""
    banded = table(spark, folder, "customer").select(
        "c_custkey",
        "c_mktsegment",
        privacy.generalise(F.col("c_acctbal"), 500).cast("double").alias("balance_from"),
    )
    return privacy.suppress_rare(banded, ["c_mktsegment"], "balance_from", 12)


@query
def pii_mondrian(spark, folder):
    """Customers in groups of at least twelve that share ranges of nation and balance: what
    must hold of them."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    found = written(
        anonymity.mondrian(customers, ["c_nationkey", "c_acctbal"], 12), "mondrian")
    inside = F.lit(True)
    for name in ("c_nationkey", "c_acctbal"):
        inside = inside & F.col(name).between(F.col(f"{name}_from"), F.col(f"{name}_to"))
    groups = found.withColumn("inside", inside).groupBy("group").agg(
        F.count("*").alias("n"), F.min("inside").alias("inside"),
        F.count_distinct("c_nationkey_from", "c_nationkey_to", "c_acctbal_from", "c_acctbal_to").alias("ranges"))
    return groups.agg(
        F.sum("n").alias("customers"), (F.min("n") >= 12).alias("all_large_enough"),
        F.min("inside").alias("ranges_hold"), (F.max("ranges") == 1).alias("ranges_shared"),
        (F.max("n") < 48).alias("none_far_too_large"),
    )
