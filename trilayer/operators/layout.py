"""Jobs that change how a table lies in files, never its rows."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, isfinite

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trilayer.operators.joins import broadcast_if_small
from trilayer.session import conf
from trilayer.sources.raw import list_files, plain_path, read_raw
from trilayer.sources.writers import write_layer

FILE_BYTES = 1 << 30


def table_bytes(spark: SparkSession, path: str) -> int:
    return list_files(spark, path).agg(F.sum("length")).first()[0] or 0


def file_profile(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: size and rows. Rows are counted from the file footers."""
    return (
        read_raw(spark, path)
        .groupBy(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_size").alias("bytes"),
        )
        .agg(F.count("*").alias("rows"))
    )


def table_detail(spark: SparkSession, path: str) -> DataFrame:
    """One row: number of files and bytes, from the file listing alone."""
    return list_files(spark, path).agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes")
    )


def compact(
    spark: SparkSession,
    source: str,
    destination: str,
    partition_by: Sequence[str] = (),
    where: str | None = None,
    file_bytes: int = FILE_BYTES,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Rewrite a table into files of about ``file_bytes``. ``schema`` is the table's; one
    without files needs it.

    ``where``, a condition on partition columns, picks the partitions to rewrite; the
    others are carried over in as many files as their tasks write.

    An unpartitioned table needs no shuffle: each task reads small files up to
    ``file_bytes`` and writes one. A partitioned one is rebalanced by its partition
    columns, with a large partition spread over several tasks.
    """
    rows = read_raw(spark, source, schema=schema)
    if where and not partition_by:
        raise ValueError("only a partitioned table can be compacted in part")
    if partition_by:
        chosen = rows.filter(where) if where else rows
        write_layer(
            chosen, destination, partition_by=partition_by, rebalance=True, file_bytes=file_bytes
        )
        if where:
            others = rows.filter(~F.coalesce(F.expr(where), F.lit(False)))
            write_layer(others, destination, "append", partition_by=partition_by)
        return read_raw(spark, destination, schema=rows.schema)
    scan = {
        "spark.sql.files.maxPartitionBytes": str(file_bytes),
        "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.minPartitionNum": "1",
    }
    with conf(spark, scan):
        write_layer(rows, destination)
    return read_raw(spark, destination, schema=rows.schema)


def first_fit(sizes: Sequence[tuple[str, int]], limit: int) -> dict[str, int]:
    """A bin for each named size, the sizes in a bin adding up to ``limit`` at most, by
    first-fit decreasing; a larger size has a bin of its own."""
    width = 1 << max(0, len(sizes) - 1).bit_length()
    room = [limit] * (2 * width)  # of each bin, and above them the most room of two nodes
    found = {}
    for name, size in sorted(sizes, key=lambda item: (-item[1], item[0])):
        size = min(size, limit)
        node = 1
        while node < width:
            node = 2 * node if room[2 * node] >= size else 2 * node + 1
        found[name] = node - width
        room[node] -= size
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return found


def compact_small(
    spark: SparkSession,
    source: str,
    destination: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    file_bytes: int = FILE_BYTES,
    small_bytes: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Pack the small files of a table into files of up to ``file_bytes`` at
    ``destination``; files of at least ``small_bytes`` (half of that) stay where they are.

    Returns the whole table, and its files as (file, packed). Nothing at ``source`` is
    changed or deleted, so readers of the old files go on until the caller turns to the new
    list. Files are packed within their directory by first-fit decreasing; only the rows of
    packed files are shuffled, each bin to a task of its own.
    """
    small_bytes = small_bytes or file_bytes // 2
    listed = list_files(spark, source).select("path", "length")
    large = [r["path"] for r in listed.filter(F.col("length") >= small_bytes).collect()]
    folders: dict[str, list] = {}
    for row in listed.filter(F.col("length") < small_bytes).collect():  # names and sizes only
        folders.setdefault(row["path"].rpartition("/")[0], []).append(tuple(row))
    bins, count = [], 0
    for _, files in sorted(folders.items()):
        found = first_fit(files, file_bytes)
        bins += [(name, count + number) for name, number in found.items()]
        count += len(set(found.values()))
    reader = spark.read.schema(schema).option("basePath", source)
    whole = reader.parquet(*large) if large else spark.createDataFrame([], schema)
    if bins:
        of_file = spark.createDataFrame(bins, "_file string, _bin int")
        rows = reader.parquet(*[name for name, _ in bins])
        rows = rows.withColumn("_file", plain_path(F.col("_metadata.file_path")))
        known = of_file.withColumn("_file", plain_path(F.col("_file")))
        packed = rows.join(broadcast_if_small(known), "_file").repartitionById(count, "_bin")
        write_layer(packed.select(*rows.drop("_file").columns), destination, partition_by=partition_by)
        whole = whole.unionByName(read_raw(spark, destination, schema=rows.drop("_file").schema))
    manifest = spark.createDataFrame([(name, False) for name in large], "file string, packed boolean")
    if bins:
        new = list_files(spark, destination).select(F.col("path").alias("file"), F.lit(True).alias("packed"))
        manifest = manifest.unionByName(new)
    return whole, manifest


def _as_number(df: DataFrame, name: str) -> Column:
    kind = dict(df.dtypes)[name]
    column = F.col(name)
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    if kind == "date":
        return F.unix_date(column).cast("double")
    return column.cast("double")


def add_zvalue(
    df: DataFrame, columns: Sequence[str], bits: int = 8, output: str = "_z"
) -> DataFrame:
    """Interleave the bits of each column's equal-frequency bucket into one long.

    The bucket bounds are approximate quantiles, so a skewed column still spreads
    over its buckets. Null and NaN get a bucket of their own. Numeric, date and
    timestamp columns can be used.
    """
    if bits * len(columns) + len(columns) > 63:
        raise ValueError("too many bits for one long")
    numbers = {f"_n_{name}": _as_number(df, name) for name in columns}
    buckets = 1 << bits
    cuts = df.select(
        *[number.alias(name) for name, number in numbers.items()]
    ).approxQuantile(
        list(numbers), [i / buckets for i in range(1, buckets)], 1 / (4 * buckets)
    )
    # an empty or all-null column has no cut; one bound makes two buckets of it
    finite = [sorted({value for value in cut if isfinite(value)}) or [0.0] for cut in cuts]
    bounds = [[float("-inf"), *cut, float("inf")] for cut in finite or [[0.0]] * len(columns)]
    df = df.withColumns(numbers)
    bucketed = Bucketizer(
        splitsArray=bounds,
        inputCols=list(numbers),
        outputCols=[f"_b_{name}" for name in columns],
        handleInvalid="keep",
    ).transform(df)
    z = F.lit(0).cast("long")
    for bit in range(bits + 1):
        for place, name in enumerate(columns):
            unknown = F.lit(len(bounds[place]) - 1)
            index = F.coalesce(F.col(f"_b_{name}"), unknown).cast("long")
            one = F.shiftright(index, bit).bitwiseAND(F.lit(1).cast("long"))
            z = z.bitwiseOR(F.shiftleft(one, bit * len(columns) + place))
    return bucketed.withColumn(output, z).drop(
        *numbers, *[f"_b_{name}" for name in columns]
    )


def zorder_layout(
    spark: SparkSession,
    source: str,
    destination: str,
    columns: Sequence[str],
    file_bytes: int = FILE_BYTES,
    bits: int = 8,
) -> DataFrame:
    """Rewrite a table so that each file covers a small range of every column.

    Files are ranges of the z-value. Rows with the same z-value, as a frequent value
    gives, are told apart by the columns and then by a row hash, so that no file
    grows with them.
    """
    files = max(1, ceil(table_bytes(spark, source) / file_bytes))
    rows = read_raw(spark, source)
    names = rows.columns
    order = ["_z", *columns]
    arranged = (
        add_zvalue(rows, columns, bits)
        .withColumn("_spread", F.xxhash64(*names))
        .repartitionByRange(files, *order, "_spread")
        .sortWithinPartitions(*order)
        .select(*names)
    )
    write_layer(arranged, destination)
    return read_raw(spark, destination)


def skipping_report(
    spark: SparkSession, path: str, ranges: dict[str, tuple[object, object]]
) -> DataFrame:
    """How many files a conjunction of ranges must read, judged by min and max.

    ``ranges`` maps a column to its lowest and highest wanted value; None leaves a
    side open.
    """
    spans = (
        read_raw(spark, path)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(
            F.count("*").alias("rows"),
            *[F.min(name).alias(f"min_{name}") for name in ranges],
            *[F.max(name).alias(f"max_{name}") for name in ranges],
        )
    )
    needed = F.lit(True)
    for name, (low, high) in ranges.items():
        if low is not None:
            needed = needed & (F.col(f"max_{name}") >= F.lit(low))
        if high is not None:
            needed = needed & (F.col(f"min_{name}") <= F.lit(high))
    needed = F.coalesce(needed, F.lit(False))
    return spans.agg(
        F.count("*").alias("files"),
        F.count_if(needed).alias("files_read"),
        F.count_if(~needed).alias("files_skipped"),
        F.sum("rows").alias("rows"),
        F.coalesce(F.sum(F.when(needed, F.col("rows"))), F.lit(0)).alias("rows_read"),
    )
