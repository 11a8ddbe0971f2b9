from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as contract
from trilayer.plans.catalogue import QUERIES
from trilayer.plans.facts import plan_facts

DATA = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# No rows leave the JVM and no join makes all pairs.
UNWANTED = ("ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def plain(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = []
    for record in records:
        values = [record[i] for i in order]
        table.append(
            tuple(None if isinstance(v, float) and math.isnan(v) else v for v in values)
        )
    return sorted(columns), sorted(table, key=lambda row: [(v is not None, str(v)) for v in row])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, engine, name):
    df = contract.queries()[name](spark, DATA)
    found = plain([tuple(row) for row in df.collect()], df.columns)
    nodes = plan_facts(df).nodes
    assert not any(nodes[name] for name in UNWANTED)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert found[1]
        return
    cursor = engine.execute(sql)
    columns = [item[0] for item in cursor.description]
    assert found == plain(cursor.fetchall(), columns)


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_known_counts(spark):
    counts = contract.queries()["layer_counts"](spark, DATA).first()
    assert (counts["bronze_rows"], counts["silver_rows"]) == (1000, 757)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == [
        "trip_date",
        "total_trips",
        "average_trip_distance_miles",
        "total_fare_amount",
        "total_tip_amount",
        "average_trip_duration_minutes",
    ]
    assert df.count() > 0
