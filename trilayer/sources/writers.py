"""Layer writes, checked and widening appends, table registration."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from trilayer.session import conf
from trilayer.sources.raw import read_raw


# A layer is written in files of this size; compaction aims higher.
FILE_BYTES = 128 << 20
# Shuffled rows take about this many times the room of Parquet.
SHUFFLE_FACTOR = 3
# One task writes at most about this much of what was shuffled, however large the files
# that are wanted.
TASK_BYTES = 128 << 20
# Directories that a task writes side by side before it sorts the rest by them.
OPEN_FILES = 4


def write_layer(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    rebalance: bool = False,
    replace_only_written_partitions: bool = False,
    file_bytes: int = FILE_BYTES,
) -> None:
    """Write one layer as Parquet.

    ``rebalance`` adds one shuffle on the partition columns so that each directory
    gets files of about ``file_bytes``, or of what TASK_BYTES of shuffled rows make if
    that is less; Spark splits a directory that holds much of the data over several tasks.
    Without it every task writes its own file into each directory. A task sorts by
    directories only what goes beyond the first OPEN_FILES of them.
    """
    settings = {}
    if rebalance:
        df = df.hint("rebalance", *partition_by)
        size = str(min(SHUFFLE_FACTOR * file_bytes, TASK_BYTES))
        settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": size}
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        settings["spark.sql.maxConcurrentOutputFileWriters"] = str(OPEN_FILES)
    if replace_only_written_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    with conf(df.sparkSession, settings):
        writer.parquet(path)


@dataclass(frozen=True)
class SchemaDiff:
    missing: tuple[str, ...]
    extra: tuple[str, ...]
    retyped: tuple[str, ...]

    def __bool__(self) -> bool:
        return bool(self.missing or self.extra or self.retyped)


class SchemaMismatch(ValueError):
    def __init__(self, diff: SchemaDiff):
        self.diff = diff
        super().__init__(
            f"schema mismatch: missing={list(diff.missing)}, "
            f"extra={list(diff.extra)}, retyped={list(diff.retyped)}"
        )


def schema_diff(table: T.StructType, incoming: T.StructType) -> SchemaDiff:
    """How ``incoming`` differs from ``table`` by column name and type."""
    have = {field.name: field.dataType for field in table}
    got = {field.name: field.dataType for field in incoming}
    return SchemaDiff(
        missing=tuple(name for name in have if name not in got),
        extra=tuple(name for name in got if name not in have),
        retyped=tuple(name for name in have if name in got and have[name] != got[name]),
    )


def append_checked(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    schema: T.StructType | None = None,
) -> None:
    """Append only if the columns are those of the table; else raise, writing nothing.

    ``schema`` is the table's; without it, it is read from the files, where partition
    columns have the types that their names look like.
    """
    diff = schema_diff(schema or read_raw(df.sparkSession, path).schema, df.schema)
    if diff:
        raise SchemaMismatch(diff)
    write_layer(df, path, "append", partition_by)


def append_evolving(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    schema: T.StructType | None = None,
) -> T.StructType:
    """Append rows that may bring new columns; returns the widened schema.

    Rows from before read as null in the new columns. A changed type still raises.
    ``schema`` is the table's, as the last append returned it; without it the footers of
    all files are merged.
    """
    table = schema or read_evolved(df.sparkSession, path).schema
    diff = schema_diff(table, df.schema)
    if diff.retyped:
        raise SchemaMismatch(diff)
    write_layer(df, path, "append", partition_by)
    added = [field for field in df.schema if field.name in diff.extra]
    return T.StructType([*table.fields, *added])


def read_evolved(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Read a table with files of several schemas.

    With ``schema``, as returned by append_evolving, no file footers are merged.
    """
    if schema is not None:
        return read_raw(spark, path, schema=schema)
    return spark.read.option("mergeSchema", "true").parquet(path)


def use_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    spark.catalog.setCurrentDatabase(name)


def register_external(
    spark: SparkSession,
    name: str,
    path: str,
    comment: str | None = None,
    schema: T.StructType | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Name the files at ``path`` as a table; dropping the table keeps the files.

    Columns come from the files, or from ``schema`` with ``partition_by``, which a table
    without files needs.
    """
    if spark.catalog.tableExists(name):
        return
    quoted = (comment or "").replace("\\", "\\\\").replace("'", "\\'")
    text = f" COMMENT '{quoted}'" if comment else ""
    columns = parts = ""
    if schema is not None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        columns = f" ({columns})"
        if partition_by:
            parts = " PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partition_by) + ")"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name}{columns} USING PARQUET{parts}{text} LOCATION '{path}'")
    is_partitioned = any(column.isPartition for column in spark.catalog.listColumns(name))
    if is_partitioned:
        spark.catalog.recoverPartitions(name)
