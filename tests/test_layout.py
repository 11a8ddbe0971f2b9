from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from trilayer.operators import layout
from trilayer.operators.reconcile import reconcile
from trilayer.plans import catalogue
from trilayer.session import conf, sized_for
from trilayer.sources.raw import list_files, read_raw
from trilayer.sources.writers import write_layer


def same_rows(left, right):
    return reconcile(left, right).first()["contents_equal"]


@pytest.fixture
def fragments(spark, folder):
    df = spark.range(4000).select(
        "id",
        (F.xxhash64("id") % 500).alias("x"),
        # One value holds more than a third of the rows.
        F.when(F.col("id") % 5 < 2, 7).otherwise(F.xxhash64("id", F.lit(1)) % 300).alias("y"),
        (F.col("id") % 3).alias("part"),
    )
    df.repartition(20).write.parquet(f"{folder}/in")
    return f"{folder}/in"


def test_compaction_without_shuffle(spark, folder, fragments):
    assert layout.table_detail(spark, fragments).first()["files"] == 20
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    done = layout.compact(spark, fragments, f"{folder}/one")
    assert layout.table_detail(spark, f"{folder}/one").first()["files"] == 1
    assert same_rows(done, read_raw(spark, fragments))
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    half = layout.table_bytes(spark, fragments) // 4 + 1
    layout.compact(spark, fragments, f"{folder}/some", file_bytes=half)
    assert 3 <= layout.table_detail(spark, f"{folder}/some").first()["files"] <= 6


def test_compaction_of_partitions(spark, folder, fragments):
    write_layer(read_raw(spark, fragments), f"{folder}/parts", partition_by=["part"])
    files = layout.table_detail(spark, f"{folder}/parts").first()["files"]
    done = layout.compact(spark, f"{folder}/parts", f"{folder}/few", ["part"], where="part < 2")
    assert layout.table_detail(spark, f"{folder}/few").first()["files"] < files
    assert same_rows(done, read_raw(spark, f"{folder}/parts"))
    with pytest.raises(ValueError, match="partitioned"):
        layout.compact(spark, fragments, f"{folder}/no", where="part < 2")


def test_swapped_nulls_and_other_types_are_differences(spark):
    left = spark.createDataFrame([(None, 5), (1, None)], "a int, b int")
    right = spark.createDataFrame([(5, None), (None, 1)], "a int, b int")
    assert same_rows(left, left) and not same_rows(left, right)
    assert not same_rows(left, left.union(left))
    with pytest.raises(ValueError):
        reconcile(left, left.withColumn("a", F.col("a").cast("long")))


def test_a_large_partition_is_written_by_several_tasks(spark, folder):
    hot = spark.range(60000).select(F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit(1).alias("p"))
    hot.repartition(8).write.parquet(f"{folder}/in")
    layout.compact(spark, f"{folder}/in", f"{folder}/out", ["p"], file_bytes=200_000)
    assert list_files(spark, f"{folder}/out").count() > 1
    assert same_rows(read_raw(spark, f"{folder}/out"), hot)


def test_zorder_keeps_rows_and_lets_filters_skip_files(spark, folder, fragments):
    size = layout.table_bytes(spark, fragments) // 8
    done = layout.zorder_layout(spark, fragments, f"{folder}/z", ["x", "y"], size, bits=5)
    assert same_rows(done, read_raw(spark, fragments))
    for wanted in ({"x": (-490, -460)}, {"y": (200, 220)}):
        clustered = layout.skipping_report(spark, f"{folder}/z", wanted).first()
        scattered = layout.skipping_report(spark, fragments, wanted).first()
        assert scattered["files_skipped"] == 0
        assert clustered["files_skipped"] >= clustered["files"] // 3
        assert clustered["rows"] == scattered["rows"] == 4000
    # A frequent value does not make a file grow.
    profile = layout.file_profile(spark, f"{folder}/z")
    assert profile.agg(F.max("rows")).first()[0] < 1500


def test_zvalue_of_nulls_dates_and_timestamps(spark):
    df = spark.range(100).select(
        F.when(F.col("id") > 5, F.col("id")).alias("n"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"),
        F.timestamp_seconds(F.col("id")).alias("t"),
    )
    found = layout.add_zvalue(df, ["n", "d", "t"], bits=4)
    assert found.filter("_z is null").count() == 0
    assert found.columns == ["n", "d", "t", "_z"]
    with pytest.raises(ValueError):
        layout.add_zvalue(df, ["n", "d", "t"], bits=30)


def test_file_profile_counts_rows(spark, fragments):
    profile = layout.file_profile(spark, fragments)
    assert profile.count() == 20
    assert profile.agg(F.sum("rows"), F.sum("bytes")).first()[0] == 4000


def test_sizes_grow_with_the_input_within_bounds():
    def sizes(input_bytes):
        return tuple(int(value) for value in sized_for(input_bytes).values())

    assert sizes(1 << 30) == (128 << 20, 200)
    assert sizes(1 << 40) == (128 << 20, 1024)
    assert sizes(10 << 40) == (512 << 20, 10240)
    assert sizes(100 << 40) == (512 << 20, 50_000)


def test_settings_are_put_back_after_an_error(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(RuntimeError), conf(
        spark, {"spark.sql.shuffle.partitions": "3", "trilayer.test": "x"}
    ):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
        raise RuntimeError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("trilayer.test", None) is None


def test_skipping_report_of_open_ranges(spark, fragments):
    report = layout.skipping_report(spark, fragments, {"id": (None, -1)}).first()
    assert (report["files_read"], report["rows_read"]) == (0, 0)
    report = layout.skipping_report(spark, fragments, {"id": (0, None)}).first()
    assert report["files_read"] == 20
    assert rows(read_raw(spark, fragments).agg(F.count("*"))) == [(4000,)]


def test_first_fit_fills_bins_to_the_limit():
    found = layout.first_fit([("a", 6), ("b", 5), ("c", 4), ("d", 3), ("e", 2), ("f", 40)], 10)
    assert found == {"f": 0, "a": 1, "b": 2, "c": 1, "d": 2, "e": 2}
    assert layout.first_fit([], 10) == {} and layout.first_fit([("a", 0)], 10) == {"a": 0}
    sizes = [(f"n{i}", i * 7919 % 97 + 1) for i in range(300)]
    found, plain = layout.first_fit(sizes, 100), []
    for name, size in sorted(sizes, key=lambda item: (-item[1], item[0])):
        at = next((i for i, room in enumerate(plain) if room >= size), len(plain))
        plain += [100] if at == len(plain) else []
        plain[at] -= size
        assert found[name] == at


def test_only_small_files_are_packed(spark, folder):
    source, packed = f"{folder}/table", f"{folder}/packed"
    spark.range(0, 50_000).withColumn("part", F.lit(1)).coalesce(1).write.partitionBy("part").parquet(source)
    for part in (1, 2):
        rows = spark.range(100_000 * part, 100_000 * part + 400).withColumn("part", F.lit(part))
        rows.repartition(20).write.mode("append").partitionBy("part").parquet(source)
    before = {r["path"]: r["modificationTime"] for r in layout.list_files(spark, source).collect()}
    whole = spark.read.parquet(source)
    found, files = layout.compact_small(
        spark, source, packed, whole.schema, ["part"], file_bytes=100_000, small_bytes=50_000)
    after = {r["path"]: r["modificationTime"] for r in layout.list_files(spark, source).collect()}
    assert before == after
    listed = files.collect()
    assert [r["packed"] for r in listed].count(False) == 1
    assert len(listed) <= 5 and len(before) == 41
    assert found.columns == whole.columns
    assert found.groupBy("part").agg(F.count("*"), F.sum("id")).orderBy("part").collect() == (
        whole.groupBy("part").agg(F.count("*"), F.sum("id")).orderBy("part").collect())


def test_nothing_small_and_nothing_large(spark, folder):
    spark.range(1000).coalesce(1).write.parquet(f"{folder}/one")
    schema = spark.range(1).schema
    found, files = layout.compact_small(spark, f"{folder}/one", f"{folder}/p1", schema, file_bytes=1000)
    assert found.count() == 1000 and [r["packed"] for r in files.collect()] == [False]
    found, files = layout.compact_small(spark, f"{folder}/one", f"{folder}/p2", schema)
    assert found.count() == 1000 and [r["packed"] for r in files.collect()] == [True]
    spark.range(0).write.parquet(f"{folder}/none")
    found, _ = layout.compact_small(spark, f"{folder}/none", f"{folder}/p3", schema)
    assert found.count() == 0


def test_large_tables_are_laid_out_by_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(catalogue, "PIECE_ROWS", 1000)
    written = []
    keep = catalogue.write_layer

    def write(df, path, *how, **more):
        keep(df, path, *how, **more)
        written.append(layout.list_files(spark, path).count())

    monkeypatch.setattr(catalogue, "write_layer", write)
    found = rows(catalogue.QUERIES["compact_small"](spark, "/root/testdata/sf0.001"))
    lines = catalogue.table(spark, "/root/testdata/sf0.001", "lineitem")
    assert rows(catalogue._line_totals(lines)) == found
    assert written[0] == catalogue._pieces(lines, 1) == -(-lines.count() // 1000)
    catalogue.QUERIES["compact_partitions"](spark, "/root/testdata/sf0.001")
    assert written[-1] > 4 * lines.select(F.year("l_shipdate")).distinct().count()


def test_files_of_a_scan_all_have_rows(spark, folder):
    spark.range(0, 100, 1, 10).write.parquet(f"{folder}/full")
    with conf(spark, {"spark.sql.files.maxPartitionBytes": "1", "spark.sql.files.openCostInBytes": "0"}):
        spark.range(0, 100, 1, 1).write.parquet(f"{folder}/sparse")
        for name in ("full", "sparse"):
            scan = spark.read.parquet(f"{folder}/{name}")
            path = f"{folder}/{name}-eight"
            catalogue._in_files(scan, 8).write.parquet(path)
            assert layout.list_files(spark, path).count() == 8
            assert rows(spark.read.parquet(path)) == rows(scan)
