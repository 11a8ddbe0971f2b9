from __future__ import annotations

from pyspark.sql import functions as F

from trilayer.operators import file_index


def land(spark, path, low, high, more=""):
    rows = spark.range(low, high).selectExpr("id", "IF(id % 10 = 3, NULL, CAST(id AS STRING)) AS name", "id % 7 AS k")
    rows.coalesce(1).write.mode("append").parquet(path + more)


def opened(df):
    return len(df.inputFiles())


def table_of(spark, folder):
    for low in range(0, 1000, 100):
        land(spark, folder, low, low + 100)
    return spark.read.parquet(folder).schema


def test_only_files_that_may_hold_rows_are_opened(spark, folder):
    schema = table_of(spark, folder)
    index = file_index.index_files(spark, folder, ["id"], ["name"])
    assert index.count() == 10 and index.agg(F.sum("rows")).first()[0] == 1000
    found = file_index.indexed_read(spark, folder, schema, index, {"id": (250, 420)})
    assert opened(found) == 3 and found.count() == 171
    found = file_index.indexed_read(spark, folder, schema, index, {"id": (None, 120)})
    assert opened(found) == 2 and found.count() == 121
    found = file_index.indexed_read(spark, folder, schema, index, lookups={"name": ["512", "718", "absent"]})
    assert opened(found) <= 3 and sorted(r["id"] for r in found.collect()) == [512, 718]
    both = file_index.indexed_read(spark, folder, schema, index, {"id": (0, 600)}, {"name": ["512", "718"]})
    assert [r["id"] for r in both.collect()] == [512]
    assert file_index.indexed_read(spark, folder, schema, index, {"id": (5000, None)}).count() == 0


def test_no_row_is_missed_by_any_filter(spark, folder):
    """Also with filters that are nearly full."""
    table_of(spark, folder)
    for bits in (64, 1 << 10):
        index = file_index.index_files(spark, folder, ["id"], ["name", "k"], bits=bits)
        for value in ("5", "499", "987"):
            chosen = {r["file"].rpartition("/")[2] for r in file_index.files_for(index, lookups={"name": [value]}).collect()}
            holding = spark.read.parquet(folder).filter(F.col("name") == value).select("_metadata.file_name")
            assert {r[0] for r in holding.collect()} <= chosen
        assert file_index.files_for(index, lookups={"k": [3]}).count() == 10


def test_a_second_index_scans_new_files_only(spark, folder, monkeypatch):
    schema = table_of(spark, folder)
    first = file_index.index_files(spark, folder, ["id"], ["name"])
    land(spark, folder, 5000, 5100)
    scanned = []
    plain = file_index._filters
    monkeypatch.setattr(file_index, "_filters", lambda rows, *how: scanned.append(opened(rows)) or plain(rows, *how))
    second = file_index.index_files(spark, folder, ["id"], ["name"], known=first)
    assert scanned == [1] and second.count() == 11
    again = file_index.index_files(spark, folder, ["id"], ["name"], known=second)
    assert again.count() == 11 and sorted(again.columns) == sorted(first.columns)
    found = file_index.indexed_read(spark, folder, schema, again, {"id": (950, 5001)})
    assert found.count() == 52


def test_partitions_nulls_and_no_files(spark, folder):
    rows = spark.range(60).selectExpr("IF(id < 30, NULL, id) AS id", "id % 3 AS part")
    rows.write.partitionBy("part").parquet(folder)
    schema = spark.read.parquet(folder).schema
    index = file_index.index_files(spark, folder, ["id"], schema=schema)
    found = file_index.indexed_read(spark, folder, schema, index, {"id": (40, 50)})
    assert found.count() == 11 and {r["part"] for r in found.collect()} == {0, 1, 2}
    rows.limit(0).write.parquet(f"{folder}-none")
    none = file_index.index_files(spark, f"{folder}-none", ["id"], ["id"], schema=rows.schema)
    assert file_index.indexed_read(spark, f"{folder}-none", rows.schema, none, {"id": (0, 9)}).count() == 0
