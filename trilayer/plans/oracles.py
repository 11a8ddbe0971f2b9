"""Plain SQL for each query, to be run by another engine on the same tables."""

from __future__ import annotations

# Written apart from the patterns of the library; the engine has no look-behind.
EMAIL = (r"[\p{L}\p{M}\p{N}._%+-]+@[\p{L}\p{M}\p{N}.-]+\.\p{L}{2,}", 0)
PHONE = (
    r"(?:^|[^\p{L}\p{N}.+-])(\+[0-9]{1,3}(?:[ .-]?\([0-9]{1,4}\))?(?:[ .-]?[0-9]{2,4}){2,4}"
    r"|(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[.-])?[0-9]{3}-[0-9]{4})(?:[^\p{L}\p{N}.-]|[.-][^0-9]|$)",
    1,
)


def _or_special(name: str, result: str) -> str:
    """``result``, or the sum of the NaN and infinite amounts if there are any."""
    odd = f"FILTER (WHERE NOT isfinite(CAST({name} AS DOUBLE)))"
    return (
        f"CASE WHEN count(*) {odd} > 0 THEN sum(CAST({name} AS DOUBLE)) {odd} ELSE {result} END"
    )


def _amount(name: str) -> str:
    return (
        f"sum(CAST(CASE WHEN isfinite(CAST({name} AS DOUBLE)) THEN {name} END AS DECIMAL(28,10)))"
    )


def _rounded_sum(name: str) -> str:
    return _or_special(name, f"CAST(round({_amount(name)}, 2) AS DOUBLE)")


def _average(name: str) -> str:
    return _or_special(name, f"CAST({_amount(name)} AS DOUBLE) / nullif(count({name}), 0)")


def _round2(value: str) -> str:
    return (
        f"CASE WHEN isfinite(CAST({value} AS DOUBLE)) THEN "
        f"CAST(round(CAST({value} AS DECIMAL(28,10)), 2) AS DOUBLE) ELSE {value} END"
    )


_TRIPS = """
e AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CASE WHEN event_type = 'purchase' THEN value * 0.25 END AS tip,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts
  FROM events
),
trips AS (
  SELECT event_id, CAST(length(event_type) AS INTEGER) AS VendorID,
         ts AS tpep_pickup_datetime, next_ts AS tpep_dropoff_datetime,
         nullif(k % 7, 6) AS passenger_count, value - 1.0 AS trip_distance,
         nullif(k % 5, 0) AS RatecodeID, 'N' AS store_and_fwd_flag,
         user_id AS PULocationID, k AS DOLocationID, k % 4 + 1 AS payment_type,
         value AS fare_amount, CAST(0.5 AS DOUBLE) AS extra, CAST(0.5 AS DOUBLE) AS mta_tax,
         tip AS tip_amount, CAST(0.0 AS DOUBLE) AS tolls_amount,
         CAST(0.3 AS DOUBLE) AS improvement_surcharge,
         value + coalesce(tip, 0.0) AS total_amount,
         CAST(CASE WHEN k % 2 = 0 THEN 2.5 END AS DOUBLE) AS congestion_surcharge,
         CAST(NULL AS DOUBLE) AS airport_fee
  FROM e
)"""

_FILLED = f"""{_TRIPS},
filled AS (
  SELECT event_id, VendorID AS vendor_id, tpep_pickup_datetime, tpep_dropoff_datetime,
         coalesce(passenger_count, 1) AS passenger_count, trip_distance,
         coalesce(RatecodeID, 99) AS rate_code_id, store_and_fwd_flag,
         CAST(PULocationID AS INTEGER) AS pickup_location_id,
         DOLocationID AS dropoff_location_id, payment_type, fare_amount, extra, mta_tax,
         coalesce(tip_amount, 0.0) AS tip_amount, tolls_amount, improvement_surcharge,
         total_amount, coalesce(congestion_surcharge, 0.0) AS congestion_surcharge,
         coalesce(airport_fee, 0.0) AS airport_fee,
         CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year,
         CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month,
         date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) AS seconds
  FROM trips
)"""

_RULES = {
    "distance_not_negative": "trip_distance >= 0",
    "fare_not_negative": "fare_amount >= 0",
    "total_not_negative": "total_amount >= 0",
    "has_passengers": "passenger_count > 0",
    "pickup_before_dropoff": "tpep_pickup_datetime <= tpep_dropoff_datetime",
    "longer_than_10_seconds": "seconds > 10",
    "shorter_than_24_hours": "seconds < 86400",
}
_VALID = " AND ".join(_RULES.values())

_MINUTES = _round2("seconds / 60.0")

_SILVER = f"""{_FILLED},
silver AS (
  SELECT * EXCLUDE (seconds), seconds AS trip_duration_seconds,
         {_MINUTES} AS trip_duration_minutes,
         CASE WHEN seconds > 0
              THEN {_round2("trip_distance / (CAST(seconds AS DOUBLE) / 3600)")}
              ELSE 0.0 END AS average_speed_mph
  FROM filled WHERE {_VALID}
)"""

_DAY = "date_trunc('day', tpep_pickup_datetime)"
_DAY_TS = f"CAST({_DAY} AS TIMESTAMP)"

_DAILY = f"""{_SILVER},
daily AS (
  SELECT {_DAY_TS} AS trip_date, count(*) AS total_trips,
         {_round2(_average("trip_distance"))} AS average_trip_distance_miles,
         {_rounded_sum("fare_amount")} AS total_fare_amount,
         {_rounded_sum("tip_amount")} AS total_tip_amount,
         {_round2(_average("trip_duration_minutes"))} AS average_trip_duration_minutes
  FROM silver GROUP BY 1
)"""

_DECLARED = f"""{_TRIPS},
shaped AS (
  SELECT event_id, VendorID AS vendor_id, tpep_pickup_datetime, tpep_dropoff_datetime,
         coalesce(passenger_count, 1) AS passenger_count, trip_distance,
         PULocationID AS pickup_location_id, DOLocationID AS dropoff_location_id,
         fare_amount, coalesce(tip_amount, 0.0) AS tip_amount, total_amount,
         {_round2("date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) / 60.0")}
           AS trip_duration_minutes,
         CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year,
         CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month
  FROM trips
),
checked AS (
  SELECT * FROM shaped
  WHERE tpep_pickup_datetime <= tpep_dropoff_datetime AND trip_distance >= 0
)"""


def _failed(name: str, condition: str, action: str) -> str:
    return (
        f"SELECT '{name}' AS rule, '{action}' AS action, "
        f"count(*) FILTER (WHERE {condition}) AS passed, "
        f"count(*) FILTER (WHERE ({condition}) IS NOT TRUE) AS failed FROM shaped"
    )


def _joined(condition: str, output: str) -> str:
    return f"""WITH {_DAILY}
SELECT event_id, tpep_pickup_datetime, pickup_location_id, total_amount,
       d.total_trips AS {output}
FROM silver s JOIN daily d ON {_DAY_TS} = d.trip_date
WHERE {condition}"""


_ORDER_CHANGES = """
changes AS (
  SELECT *, 'UPDATE' AS op FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL
  SELECT *, 'INSERT' FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'P'
  UNION ALL
  SELECT *, 'DELETE' FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'F'
)"""


def _merged_orders(with_delete: bool) -> str:
    gone = "WHERE op IS DISTINCT FROM 'DELETE'" if with_delete else ""
    return f"""WITH {_ORDER_CHANGES},
matched AS (
  SELECT o.*, c.op FROM orders o
  LEFT JOIN changes c ON o.o_orderkey = c.o_orderkey AND c.op <> 'INSERT'
)
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN op = 'UPDATE' THEN o_totalprice + 5.0 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority
FROM matched {gone}
UNION ALL
SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM changes WHERE op = 'INSERT'"""


_SHIFTED = f"""{_SILVER},
model AS (SELECT * FROM silver WHERE tip_amount > 75),
later AS (
  SELECT *, 1 AS number, 141 AS new_dropoff, 8.88 AS new_tip,
         tpep_pickup_datetime + INTERVAL 365 DAY - INTERVAL 120 MINUTE AS p,
         tpep_pickup_datetime + INTERVAL 365 DAY - INTERVAL 90 MINUTE AS d FROM model
  UNION ALL
  SELECT *, 2, 236, 4.44,
         tpep_pickup_datetime + INTERVAL 365 DAY - INTERVAL 180 MINUTE,
         tpep_pickup_datetime + INTERVAL 365 DAY - INTERVAL 135 MINUTE FROM model
),
timed AS (SELECT *, date_diff('second', p, d) AS s FROM later),
trip_changes AS (
  SELECT * REPLACE (tip_amount + 5.0 AS tip_amount, total_amount + 5.0 AS total_amount),
         'UPDATE' AS merge_operation, CAST(NULL AS VARCHAR) AS data_source_quality
  FROM silver WHERE tip_amount > 50
  UNION ALL BY NAME
  SELECT * EXCLUDE (number, new_dropoff, new_tip, p, d, s) REPLACE (
           p AS tpep_pickup_datetime, d AS tpep_dropoff_datetime,
           -2 * event_id - number AS event_id, 2 AS passenger_count,
           new_dropoff AS dropoff_location_id, CAST(new_tip AS DOUBLE) AS tip_amount,
           CAST(41.5 AS DOUBLE) AS fare_amount, CAST(52.25 AS DOUBLE) AS total_amount,
           CAST(9.6 AS DOUBLE) AS trip_distance, s AS trip_duration_seconds,
           {_round2("s / 60.0")} AS trip_duration_minutes,
           {_round2("CAST(9.6 AS DOUBLE) / (CAST(s AS DOUBLE) / 3600)")} AS average_speed_mph,
           CAST(year(p) AS INTEGER) AS pickup_year,
           CAST(month(p) AS INTEGER) AS pickup_month),
         'INSERT' AS merge_operation, 'New' AS data_source_quality
  FROM timed
)"""

_LOG = """
log AS (
  SELECT *, 0 AS version, 'INSERT' AS op, 'WRITE' AS operation
  FROM orders WHERE o_orderpriority <> '5-LOW'
  UNION ALL
  SELECT * REPLACE (o_totalprice + 5.0 AS o_totalprice), 1, 'UPDATE', 'UPDATE'
  FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL
  SELECT * REPLACE (o_totalprice + 5.0 AS o_totalprice), 2, 'UPDATE', 'MERGE'
  FROM orders WHERE o_orderpriority = '2-HIGH'
  UNION ALL
  SELECT *, 2, 'INSERT', 'MERGE' FROM orders WHERE o_orderpriority = '5-LOW'
  UNION ALL
  SELECT *, 2, 'DELETE', 'MERGE' FROM orders WHERE o_orderpriority = '3-MEDIUM'
)"""


def _state(version: int) -> str:
    return f"""WITH {_LOG},
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) AS n
  FROM log WHERE version <= {version}
)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM numbered WHERE n = 1 AND op <> 'DELETE'"""


_LINE_TOTALS = f"""
SELECT l_returnflag, l_linestatus, count(*) AS lines,
       {_rounded_sum("l_quantity")} AS quantity,
       {_rounded_sum("l_extendedprice")} AS price,
       min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
FROM lineitem GROUP BY 1, 2"""

_WINDOWS = """
counts AS (
  SELECT time_bucket(INTERVAL 10 MINUTE, ts, TIMESTAMP '1970-01-01') AS window_start,
         time_bucket(INTERVAL 10 MINUTE, ts, TIMESTAMP '1970-01-01') + INTERVAL 10 MINUTE
           AS window_end,
         user_id AS pickup_location_id, count(*) AS trip_count
  FROM events GROUP BY ALL
),
closed AS (
  SELECT * FROM counts
  WHERE window_end <= (SELECT date_trunc('milliseconds', max(ts)) FROM events)
                      - INTERVAL 20 MINUTE
)"""


def _found(kind: str, how: tuple[str, int]) -> str:
    pattern, group = how
    return f"""
SELECT doc_id, unnest(hits) AS {kind},
       CAST(unnest(range(len(hits))) AS INTEGER) AS position
FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}', {group}) AS hits FROM documents)"""


_EMAILS = f"found AS ({_found('email', EMAIL)})"

ORACLES: dict[str, str] = {
    "bronze_ingest": f"""WITH {_TRIPS}
SELECT *, CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year,
       CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month FROM trips""",
    "bronze_partitions": """
SELECT CAST(year(ts) AS INTEGER) AS pickup_year, CAST(month(ts) AS INTEGER) AS pickup_month,
       count(*) AS partition_rows FROM events GROUP BY 1, 2""",
    "silver_cleanse": f"WITH {_FILLED} SELECT * EXCLUDE (seconds) FROM filled WHERE {_VALID}",
    "silver_rejects": f"WITH {_FILLED} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE ({condition}) IS NOT TRUE) "
        "AS rejected_rows FROM filled"
        for name, condition in _RULES.items()
    ),
    "reject_reasons": f"""WITH {_FILLED}
SELECT event_id, concat_ws(',', {", ".join(
        f"CASE WHEN ({condition}) IS NOT TRUE THEN '{name}' END"
        for name, condition in _RULES.items())}) AS failed_rules
FROM filled WHERE ({_VALID}) IS NOT TRUE""",
    "silver_enrich": f"""WITH {_SILVER}
SELECT event_id, trip_duration_seconds, trip_duration_minutes, average_speed_mph FROM silver""",
    "layer_counts": f"""WITH {_FILLED}
SELECT count(*) AS bronze_rows, count(*) FILTER (WHERE {_VALID}) AS silver_rows FROM filled""",
    "reconcile_layers": f"""WITH {_SILVER}
SELECT count(*) AS left_rows, count(*) AS right_rows, true AS counts_equal,
       true AS contents_equal FROM silver""",
    "gold_daily_summary": f"WITH {_DAILY} SELECT * FROM daily ORDER BY trip_date",
    "gold_zone_summary": f"""WITH {_SILVER}
SELECT pickup_year, pickup_month, pickup_location_id, count(*) AS total_trips,
       {_round2(_average("total_amount"))} AS average_total_amount,
       {_round2(_average("tip_amount"))} AS average_tip_amount,
       {_round2(_average("trip_distance"))} AS average_trip_distance_miles,
       count(DISTINCT vendor_id) AS distinct_vendors_count
FROM silver GROUP BY 1, 2, 3
ORDER BY pickup_year, pickup_month, total_trips DESC, pickup_location_id""",
    "declared_silver": f"WITH {_DECLARED} SELECT * FROM checked",
    "declared_daily_summary": f"""WITH {_DECLARED}
SELECT {_DAY_TS} AS trip_date, count(*) AS total_trips,
       {_round2(_average("trip_distance"))} AS average_trip_distance,
       {_rounded_sum("total_amount")} AS total_revenue
FROM checked GROUP BY 1""",
    "declared_stream": f"""WITH {_DECLARED}
SELECT {_DAY_TS} AS trip_date, count(*) AS total_trips,
       {_round2(_average("trip_distance"))} AS average_trip_distance,
       {_rounded_sum("total_amount")} AS total_revenue
FROM checked GROUP BY 1""",
    "rule_metrics": f"WITH {_DECLARED} "
    + " UNION ALL ".join(
        [
            _failed("valid_trip_distance", "trip_distance >= 0", "drop"),
            _failed("valid_fare", "fare_amount >= 0", "warn"),
            _failed("valid_pickup_time", "tpep_pickup_datetime IS NOT NULL", "fail"),
            _failed("plausible_duration", "trip_duration_minutes < 1440", "warn"),
        ]
    ),
    "pruned_avg": f"""WITH {_SILVER}
SELECT pickup_location_id, {_average("tip_amount")} AS avg_tip FROM silver
WHERE pickup_year = 2024 AND pickup_month = 1
GROUP BY pickup_location_id ORDER BY pickup_location_id""",
    "pruned_days": f"""WITH {_SILVER}
SELECT CAST(day(tpep_pickup_datetime) AS INTEGER) AS pickup_day, pickup_location_id,
       {_average("tip_amount")} AS avg_tip FROM silver
WHERE day(tpep_pickup_datetime) BETWEEN 5 AND 7 GROUP BY 1, 2""",
    "reconcile_differences": """
SELECT copy, count(*) AS left_rows, count(*) AS right_rows, true AS counts_equal,
       copy = 'same' AS contents_equal
FROM orders, (VALUES ('changed_row'), ('same'), ('swapped_nulls')) AS copies(copy) GROUP BY copy""",
    "file_profile": """
SELECT CAST(8 AS BIGINT) AS files, count(*) AS rows, true AS sizes_agree, true AS all_have_rows
FROM lineitem""",
    "skipping_report": """
SELECT count(*) AS rows, count(*) FILTER (WHERE l_partkey BETWEEN 0 AND 50) AS matching_rows,
       true AS files_add_up, true AS reads_enough, true AS skips_some FROM lineitem""",
    "compact_partitions": f"""
SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, count(*) AS lines,
       {_rounded_sum("l_quantity")} AS quantity FROM lineitem GROUP BY 1""",
    "merge_repeated_keys": f"""{_merged_orders(with_delete=False)}
UNION ALL
SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1, o_orderdate, o_orderpriority
FROM changes WHERE op = 'INSERT'""",
    "stream_by_table": f"""WITH {_TRIPS}
SELECT time_bucket(INTERVAL 10 MINUTE, tpep_pickup_datetime, TIMESTAMP '1970-01-01')
         AS window_start,
       time_bucket(INTERVAL 10 MINUTE, tpep_pickup_datetime, TIMESTAMP '1970-01-01')
         + INTERVAL 10 MINUTE AS window_end,
       PULocationID AS pickup_location_id, count(*) AS trip_count
FROM trips WHERE tpep_dropoff_datetime > tpep_pickup_datetime GROUP BY ALL""",
    "pii_vault": f"""WITH {_EMAILS},
known AS (SELECT DISTINCT email FROM found WHERE doc_id % 2 = 0)
SELECT 'tok_' || left(sha256(CASE WHEN email IN (SELECT email FROM known) THEN 'older-key'
                                  ELSE 'vault-key' END || email), 32) AS token,
       count(*) AS token_rows
FROM found GROUP BY 1""",
    "filtered_avg": f"""WITH {_SILVER}
SELECT pickup_location_id, {_average("tip_amount")} AS avg_tip FROM silver
WHERE tip_amount > 50 GROUP BY pickup_location_id ORDER BY pickup_location_id""",
    "long_trips": f"""WITH {_SILVER}
SELECT event_id, tpep_pickup_datetime, trip_distance, total_amount FROM silver
WHERE pickup_year = 2024 AND pickup_month = 1 AND trip_distance > 10""",
    "avg_fare_by_passengers": f"""WITH {_SILVER}
SELECT passenger_count, {_average("fare_amount")} AS avg_fare FROM silver GROUP BY 1""",
    "trips_by_vendor": f"""WITH {_SILVER}
SELECT vendor_id, count(*) AS trips FROM silver GROUP BY 1""",
    "earliest_trips": f"""WITH {_SILVER}
SELECT event_id, tpep_pickup_datetime, pickup_location_id, total_amount FROM silver
ORDER BY tpep_pickup_datetime, event_id LIMIT 10""",
    "join_daily_total": _joined("tip_amount > 10", "trips_on_pickup_day"),
    "join_daily_broadcast_sql": _joined("passenger_count = 1", "total_trips_on_pickup_day"),
    "join_daily_broadcast_df": _joined("passenger_count = 2", "total_trips_on_pickup_day"),
    "zone_names": """
SELECT n_name AS nation, r_name AS region, count(*) AS customers
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
    "union_by_name": f"WITH {_SHIFTED} SELECT * FROM trip_changes",
    "merge_upsert": _merged_orders(with_delete=False),
    "merge_delete": _merged_orders(with_delete=True),
    "merge_metrics": f"""WITH {_ORDER_CHANGES}
SELECT count(*) AS num_affected_rows,
       count(*) FILTER (WHERE op = 'UPDATE') AS num_updated_rows,
       count(*) FILTER (WHERE op = 'DELETE') AS num_deleted_rows,
       count(*) FILTER (WHERE op = 'INSERT') AS num_inserted_rows FROM changes""",
    "merge_artifacts": f"""WITH {_SHIFTED},
latest AS (
  SELECT * FROM trip_changes QUALIFY row_number() OVER (
    PARTITION BY tpep_pickup_datetime, tpep_dropoff_datetime, pickup_location_id,
                 dropoff_location_id, passenger_count ORDER BY event_id DESC) = 1
),
merged AS (
  SELECT t.event_id, t.tpep_pickup_datetime, t.pickup_location_id,
         coalesce(u.tip_amount, t.tip_amount) AS tip_amount,
         coalesce(u.total_amount, t.total_amount) AS total_amount,
         t.trip_duration_minutes,
         CASE WHEN u.event_id IS NOT NULL THEN 'Updated Tip' END AS data_source_quality
  FROM silver t LEFT JOIN latest u
    ON u.merge_operation = 'UPDATE'
   AND t.tpep_pickup_datetime = u.tpep_pickup_datetime
   AND t.tpep_dropoff_datetime = u.tpep_dropoff_datetime
   AND t.pickup_location_id = u.pickup_location_id
   AND t.dropoff_location_id = u.dropoff_location_id
   AND t.passenger_count = u.passenger_count
  UNION ALL
  SELECT i.event_id, i.tpep_pickup_datetime, i.pickup_location_id, i.tip_amount,
         i.total_amount, i.trip_duration_minutes, i.data_source_quality
  FROM latest i WHERE i.merge_operation = 'INSERT' AND NOT EXISTS (
    SELECT 1 FROM silver t
    WHERE t.tpep_pickup_datetime = i.tpep_pickup_datetime
      AND t.tpep_dropoff_datetime = i.tpep_dropoff_datetime
      AND t.pickup_location_id = i.pickup_location_id
      AND t.dropoff_location_id = i.dropoff_location_id
      AND t.passenger_count = i.passenger_count)
)
SELECT * FROM merged
WHERE data_source_quality = 'Updated Tip' OR tip_amount = 8.88 OR tip_amount = 4.44""",
    "change_history": f"""WITH {_LOG}
SELECT CAST(version AS BIGINT) AS version,
       TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * version AS commit_ts, operation,
       count(*) FILTER (WHERE op = 'INSERT') AS rows_inserted,
       count(*) FILTER (WHERE op = 'UPDATE') AS rows_updated,
       count(*) FILTER (WHERE op = 'DELETE') AS rows_deleted
FROM log GROUP BY ALL""",
    "as_of_version": _state(1),
    "as_of_timestamp": _state(0),
    "version_before_merge": f"""WITH {_LOG}
SELECT CAST(max(version) AS BIGINT) AS latest_version,
       CAST(max(version) FILTER (WHERE operation = 'WRITE'
            AND version < (SELECT max(version) FROM log)) AS BIGINT) AS prior_write_version,
       CAST(min(version) FILTER (WHERE operation = 'MERGE') - 1 AS BIGINT)
         AS version_before_merge FROM log""",
    "restore_version": _state(1),
    "restore_timestamp": _state(1),
    "checked_append": """
SELECT o_orderstatus, count(*) + count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS orders
FROM orders GROUP BY 1""",
    "schema_evolution": f"""
WITH grown AS (
  SELECT o_totalprice, CAST(NULL AS VARCHAR) AS data_source_quality FROM orders
  UNION ALL
  SELECT o_totalprice, 'Good' FROM orders WHERE o_orderpriority = '1-URGENT'
)
SELECT data_source_quality, count(*) AS orders,
       {_rounded_sum("o_totalprice")} AS total_price FROM grown GROUP BY 1""",
    "as_of_interval": _state(1),
    "silver_by_name": f"""WITH {_SILVER}
SELECT pickup_year, pickup_month, vendor_id, count(*) AS trips FROM silver GROUP BY ALL""",
    "running_totals": f"""WITH {_SILVER}
SELECT event_id, pickup_location_id, tpep_pickup_datetime, total_amount, fare_amount,
       count(*) OVER so_far AS trips_so_far,
       CAST(sum(CAST(total_amount AS DECIMAL(28,10))) OVER so_far AS DOUBLE) AS taken_so_far,
       max(fare_amount) OVER so_far AS highest_fare, min(fare_amount) OVER so_far AS lowest_fare
FROM silver
WINDOW so_far AS (PARTITION BY pickup_location_id ORDER BY tpep_pickup_datetime, event_id
                  ROWS UNBOUNDED PRECEDING)""",
    "gold_sketches": f"""WITH {_SILVER},
periods AS (
  SELECT 'day' AS level, {_DAY_TS} AS period, pickup_location_id FROM silver
  UNION ALL
  SELECT 'month', CAST(date_trunc('month', tpep_pickup_datetime) AS TIMESTAMP), pickup_location_id
  FROM silver
  UNION ALL
  SELECT 'all', NULL, pickup_location_id FROM silver
)
SELECT level, period, count(*) AS trips, count(DISTINCT pickup_location_id) AS zones,
       true AS zones_close, true AS median_close, true AS p95_close
FROM periods GROUP BY level, period""",
    "asof_join": """
WITH timed AS (
  SELECT o_custkey, o_totalprice, o_orderkey, TIMESTAMP '2024-01-01' + to_seconds(
    (date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) * 3671 + o_orderkey * 61)
    % 2592000) AS ordered_at
  FROM orders
)
SELECT event_id, user_id, ts, o_totalprice, o_orderkey
FROM events LEFT JOIN timed ON user_id = o_custkey AND ordered_at <= ts
QUALIFY row_number() OVER (
  PARTITION BY event_id ORDER BY ordered_at DESC, o_totalprice DESC, o_orderkey DESC) = 1""",
    "overlap_join": f"""WITH {_SILVER}
SELECT a.dropoff_location_id, a.event_id, b.event_id AS other_event_id
FROM silver a JOIN silver b ON a.dropoff_location_id = b.dropoff_location_id
 AND a.event_id < b.event_id
 AND a.tpep_pickup_datetime <= b.tpep_dropoff_datetime
 AND b.tpep_pickup_datetime <= a.tpep_dropoff_datetime""",
    "compact_small": _LINE_TOTALS,
    "pii_mondrian": """
SELECT count(*) AS customers, true AS all_large_enough, true AS ranges_hold,
       true AS ranges_shared, true AS none_far_too_large FROM customer""",
    "indexed_read": _LINE_TOTALS.replace(
        "FROM lineitem",
        "FROM (SELECT * FROM lineitem WHERE l_partkey BETWEEN 0 AND 50 "
        "UNION ALL SELECT * FROM lineitem WHERE l_partkey = 7)",
    ),
    "reconcile_rows": """
SELECT o_orderkey, CAST(1 AS BIGINT) AS left_rows,
       CAST(CASE o_orderkey % 100 WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE 2 END AS BIGINT) AS right_rows,
       CASE o_orderkey % 100 WHEN 1 THEN 'missing' WHEN 2 THEN 'changed' ELSE 'repeated' END AS kind
FROM orders WHERE o_orderkey % 100 IN (1, 2, 4)
UNION ALL
SELECT -o_orderkey, 0, 1, 'extra' FROM orders WHERE o_orderkey % 100 = 3""",
    "stream_join": """
SELECT v.user_id, v.event_id, v.ts, p.event_id AS purchase_id, p.ts AS purchase_ts, p.value
FROM events v JOIN events p ON v.user_id = p.user_id AND v.event_type = 'view'
 AND p.event_type = 'purchase' AND p.ts >= v.ts AND p.ts <= v.ts + INTERVAL 30 MINUTE""",
    "stream_sessions": """
WITH marked AS (
  SELECT *, CASE WHEN ts < lag(ts) OVER u + INTERVAL 1 HOUR THEN 0 ELSE 1 END AS begins
  FROM events WINDOW u AS (PARTITION BY user_id ORDER BY ts, event_id)
),
numbered AS (
  SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
           AS number FROM marked
)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 1 HOUR AS session_end,
       count(*) AS events
FROM numbered GROUP BY user_id, number
HAVING max(ts) + INTERVAL 1 HOUR <= (SELECT date_trunc('milliseconds', max(ts)) FROM events)
                                    - INTERVAL 20 MINUTE""",
    "stream_drift": """
SELECT event_id, ts, event_type, value,
       CASE WHEN event_id % 3 < 2 OR event_type <> 'view' THEN user_id END AS user_id,
       CASE WHEN event_id % 3 = 2 AND event_type = 'view' THEN 'u' || user_id END AS rescued_user,
       CASE WHEN event_id % 3 > 0 THEN 'c' || event_id % 4 END AS rescued_channel
FROM events""",
    "stream_evolved": """
SELECT event_id, ts, event_type, value,
       CASE WHEN event_id % 3 < 2 OR event_type <> 'view' THEN user_id END AS user_id,
       CASE WHEN event_id % 3 = 2 AND event_type = 'view' THEN 'u' || user_id END AS rescued_user,
       CASE WHEN event_id % 3 > 0 THEN 'c' || event_id % 4 END AS channel
FROM events""",
    "compact_rows": _LINE_TOTALS,
    "zorder_rows": _LINE_TOTALS,
    "stream_bronze": f"""WITH {_TRIPS}
SELECT * EXCLUDE (tpep_dropoff_datetime, PULocationID), PULocationID AS pickup_location_id
FROM trips""",
    "stream_window_counts": f"WITH {_WINDOWS} SELECT * FROM closed",
    "stream_window_counts_update": f"WITH {_WINDOWS} SELECT * FROM counts",
    "stream_window_counts_complete": f"WITH {_WINDOWS} SELECT * FROM counts",
    "stream_rules": f"""WITH {_TRIPS}
SELECT event_id, tpep_pickup_datetime, trip_distance, fare_amount
FROM trips WHERE trip_distance >= 0""",
    "first_windows": f"""WITH {_WINDOWS}
SELECT * FROM closed ORDER BY window_start, pickup_location_id LIMIT 10""",
    "pii_hash": f"""WITH {_EMAILS}
SELECT doc_id, position, sha256(email) AS email_hash,
       sha256(email || 'pepper-and-salt') AS email_hash_salted FROM found""",
    "pii_mask": f"""WITH {_EMAILS},
phones AS ({_found('phone', PHONE)})
SELECT doc_id, 'email' AS kind, position,
       left(email, 1) || '***' || substr(email, strpos(email, '@')) AS masked FROM found
UNION ALL
SELECT doc_id, 'phone', position,
       regexp_replace(left(phone, length(phone) - length(tail)), '[0-9]', 'X', 'g') || tail
FROM (SELECT *, regexp_extract(phone, '(?:[0-9][^0-9]*){{4}}$') AS tail FROM phones)""",
    "pii_tokenize": f"""WITH {_EMAILS}
SELECT 'tok_' || left(sha256('vault-key' || email), 32) AS token, count(*) AS token_rows
FROM found GROUP BY 1""",
    "pii_generalise": """
WITH banded AS (
  SELECT c_custkey, c_mktsegment,
         CAST(floor(c_acctbal / 500) * 500 AS DOUBLE) AS balance_from FROM customer
)
SELECT c_custkey, c_mktsegment,
       CASE WHEN count(*) OVER (PARTITION BY c_mktsegment, balance_from) >= 12
            THEN balance_from END AS balance_from FROM banded""",
}
