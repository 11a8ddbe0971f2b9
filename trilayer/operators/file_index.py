"""An index of a table's files that chooses which of them a read opens.

One row per file: its listing (path, size, modification time), rows, and per indexed column
the lowest and highest value, and for columns that are asked for single values a Bloom
filter. The index is a small table of its own. A read takes the files that may hold wanted
rows and still filters their rows, so an index can cost a read of too much, never a row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trilayer.operators.joins import broadcast_if_small
from trilayer.sources.raw import list_files, plain_path, read_raw
from trilayer.workspace import written

#: Bits of a Bloom filter per file and column, and bits that a value sets. A filter stays
#: useful up to about a tenth as many distinct values; beyond that it lets files through.
BLOOM_BITS = 1 << 17
PROBES = 4


def _probes(value: Column, bits: int) -> Column:
    """The bits that a value sets."""
    text = value.cast("string")
    return F.array(*[F.pmod(F.xxhash64(text, F.lit(seed)), F.lit(bits)) for seed in range(PROBES)])


def _filters(rows: DataFrame, column: str, bits: int) -> DataFrame:
    """(file, ``bloom_<column>``): the set words of each file's filter, as a map."""
    hits = rows.filter(F.col(column).isNotNull()).select("file", column).distinct()
    words = hits.select("file", F.explode(_probes(F.col(column), bits)).alias("bit")).groupBy(
        "file", F.floor(F.col("bit") / 64).cast("int").alias("word")
    ).agg(F.expr("bit_or(shiftleft(1L, int(bit % 64)))").alias("set"))
    # at most bits / 64 words a file
    entries = F.collect_list(F.struct("word", "set"))
    return words.groupBy("file").agg(F.map_from_entries(entries).alias(f"bloom_{column}"))


def index_files(
    spark: SparkSession,
    path: str,
    ranges: Sequence[str],
    lookups: Sequence[str] = (),
    known: DataFrame | None = None,
    schema: T.StructType | None = None,
    bits: int = BLOOM_BITS,
) -> DataFrame:
    """The index of the files at ``path``, as a table that has been written.

    ``ranges`` are columns of which lowest and highest values are kept, ``lookups`` those
    with a Bloom filter. With ``known``, an index of the same columns made before, only
    files that are new or changed since are scanned, and files that are gone are dropped.
    """
    listed = list_files(spark, path).select(
        F.col("path").alias("file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")
    )
    listing = ["file", "bytes", "modified"]
    fresh = listed
    if known is not None:
        kept = known.join(broadcast_if_small(listed), listing, "left_semi")
        fresh = listed.join(broadcast_if_small(known.select(*listing)), listing, "left_anti")
    fresh = written(fresh, "index-listing")
    names = [r["file"] for r in fresh.select("file").collect()]  # names only
    whole = schema or read_raw(spark, path).schema
    if names:
        rows = spark.read.schema(whole).option("basePath", path).parquet(*names)
        rows = rows.select(*{*ranges, *lookups}, plain_path(F.col("_metadata.file_path")).alias("file"))
    else:
        rows = spark.createDataFrame([], whole).select(*{*ranges, *lookups}, F.lit("").alias("file"))
    bounds = rows.groupBy("file").agg(
        F.count("*").alias("rows"),
        *[F.min(c).alias(f"min_{c}") for c in ranges], *[F.max(c).alias(f"max_{c}") for c in ranges],
    )
    found = fresh.withColumn("_file", plain_path(F.col("file"))).join(
        bounds.withColumnRenamed("file", "_file"), "_file", "left")
    for column in lookups:
        filters = _filters(rows, column, bits).withColumnRenamed("file", "_file")
        found = found.join(filters, "_file", "left")
    found = found.withColumn("rows", F.coalesce("rows", F.lit(0))).withColumn("bits", F.lit(bits)).drop("_file")
    if known is not None:
        found = kept.unionByName(found)
    return written(found, "file-index")


def files_for(
    index: DataFrame,
    ranges: Mapping[str, tuple[object, object]] | None = None,
    lookups: Mapping[str, Sequence[object]] | None = None,
) -> DataFrame:
    """Index rows of the files that may hold a row within all ``ranges`` (lowest and highest
    value, None for an open side) and with one of the values of each of ``lookups``."""
    may = F.col("rows") > 0
    for column, (low, high) in (ranges or {}).items():
        if low is not None:
            may = may & (F.col(f"max_{column}") >= F.lit(low))
        if high is not None:
            may = may & (F.col(f"min_{column}") <= F.lit(high))
    for column, values in (lookups or {}).items():
        words, some = F.col(f"bloom_{column}"), F.lit(False)
        for value in values:
            probes = [F.pmod(F.xxhash64(F.lit(value).cast("string"), F.lit(s)), F.col("bits")) for s in range(PROBES)]
            every = F.lit(True)
            for bit in probes:
                word = F.coalesce(F.try_element_at(words, F.floor(bit / 64).cast("int")), F.lit(0))
                every = every & (F.call_function("getbit", word, (bit % 64).cast("int")) == 1)
            some = some | every
        may = may & some
    return index.filter(F.coalesce(may, F.lit(False)))


def indexed_read(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    index: DataFrame,
    ranges: Mapping[str, tuple[object, object]] | None = None,
    lookups: Mapping[str, Sequence[object]] | None = None,
) -> DataFrame:
    """The wanted rows of the table; only files that may hold some are opened.

    Lookup values must have the column's own type. A null is within no range.
    """
    chosen = [r["file"] for r in files_for(index, ranges, lookups).select("file").collect()]
    if not chosen:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*chosen)
    for column, (low, high) in (ranges or {}).items():
        if low is not None:
            rows = rows.filter(F.col(column) >= F.lit(low))
        if high is not None:
            rows = rows.filter(F.col(column) <= F.lit(high))
    for column, values in (lookups or {}).items():
        rows = rows.filter(F.col(column).isin(list(values)))
    return rows
