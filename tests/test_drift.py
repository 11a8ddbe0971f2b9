from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from trilayer.streaming import drift


def land(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/landed")


def ingest(spark, folder, **how):
    drift.ingest_drifting(spark, f"{folder}/landed", f"{folder}/table", f"{folder}/check", **how)
    return drift.read_drifted(spark, f"{folder}/table", f"{folder}/check")


def texts(df):
    rows = df.withColumn("_rescued", F.to_json("_rescued")).collect()
    return sorted(
        ((tuple(None if v is None else str(v) for v in row[:-1]), json.loads(row[-1]) if row[-1] else None)
         for row in rows), key=str)


def land_all(spark, folder):
    land(spark, folder, [(1, 1.5), (2, None)], "id int, v double")
    land(spark, folder, [(3, 2.5, "new"), (4, None, None)], "id int, v double, extra string")
    land(spark, folder, [("5", "0.5"), ("x6", "n/a"), ("07", None)], "id string, v string")
    land(spark, folder, [(8, [1, 2], {"a": 1})], "id long, tags array<int>, m map<string,int>")
    land(spark, folder, [(2**40, 9.0)], "ID long, V float")


def test_nothing_is_lost_under_a_fixed_schema(spark, folder):
    land_all(spark, folder)
    found = ingest(spark, folder)
    assert found.columns == ["id", "v", "_rescued"]
    want = [
        (("1", "1.5"), None), (("2", None), None), (("3", "2.5"), {"extra": "new"}),
        (("4", None), None), (("5", "0.5"), None), ((None, None), {"id": "x6", "v": "n/a"}),
        ((None, None), {"id": "07"}), (("8", None), {"tags": "[1,2]", "m": '{"a":1}'}),
        ((None, "9.0"), {"id": str(2**40)}),
    ]
    assert texts(found) == sorted(want, key=str)


def test_new_fields_become_columns(spark, folder):
    land_all(spark, folder)
    found = ingest(spark, folder, evolve=True)
    assert found.columns[:2] == ["id", "v"] and set(found.columns[2:-1]) == {"extra", "tags", "m"}
    rows = {r["id"]: r for r in found.collect() if r["id"] is not None}
    assert rows[3]["extra"] == "new" and rows[1]["extra"] is None
    assert rows[8]["tags"] == [1, 2] and rows[8]["m"] == {"a": 1}
    assert rows[8]["_rescued"] is None
    assert found.count() == 9


def test_a_restart_goes_on_with_the_schema(spark, folder):
    land(spark, folder, [(1, 1.5)], "id int, v double")
    assert ingest(spark, folder, evolve=True).columns == ["id", "v", "_rescued"]
    land(spark, folder, [(2, "b")], "id int, extra string")
    assert ingest(spark, folder, evolve=True).columns == ["id", "v", "extra", "_rescued"]
    land(spark, folder, [(3, 7)], "id int, extra int")
    found = ingest(spark, folder, evolve=True)
    assert sorted((r["id"], r["v"], r["extra"]) for r in found.collect()) == [
        (1, 1.5, None), (2, None, "b"), (3, None, "7")]
    assert found.count() == ingest(spark, folder, evolve=True).count() == 3


def test_a_repeated_batch_replaces_itself(spark, folder):
    land_all(spark, folder)
    ingest(spark, folder)
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{folder}/landed")
    sink = drift.drift_sink(f"{folder}/table", f"{folder}/check-schema", False)
    sink(names.select("path"), 0)
    assert drift.read_drifted(spark, f"{folder}/table", f"{folder}/check").count() == 9


def test_small_batches_and_files_without_rows(spark, folder):
    land_all(spark, folder)
    land(spark, folder, [], "id int, v double, late string")
    found = ingest(spark, folder, evolve=True, max_files_per_trigger=1)
    assert found.count() == 9 and "late" in found.columns


def test_fields_that_differ_in_case_only(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        rows = spark.createDataFrame([(1, 2)], "v int, V int")
        wanted = spark.createDataFrame([], "v int").schema
        assert drift.align(rows, wanted).first()[:] == (1, {"V": "2"})
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_no_file_to_begin_with(spark, folder):
    spark.range(1).write.json(f"{folder}/landed")
    with pytest.raises(ValueError):
        ingest(spark, folder)
