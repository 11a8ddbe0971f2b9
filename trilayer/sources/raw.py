"""Batch and streaming reads."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_raw(
    spark: SparkSession,
    path: str,
    glob: str | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_raw(spark, f"{folder}/{name}.parquet")


def add_ingest_metadata(
    df: DataFrame,
    time_column: str = "ingestion_timestamp",
    file_column: str = "source_file",
) -> DataFrame:
    """Processing time and source file of each row; call it right on the scan."""
    return df.select(
        "*",
        F.current_timestamp().alias(time_column),
        F.col("_metadata.file_path").alias(file_column),
    )


def infer_or_load_schema(
    spark: SparkSession, path: str, schema_path: str, glob: str | None = None
) -> T.StructType:
    """The schema stored at ``schema_path``; inferred from the files the first time.

    A stream that restarts keeps the schema it began with, whatever files came since.
    """
    try:
        saved = spark.read.text(schema_path, wholetext=True).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        saved = None
    if saved is not None:
        return T.StructType.fromJson(json.loads(saved[0]))
    schema = read_raw(spark, path, glob).schema
    spark.createDataFrame([(schema.json(),)], "schema string").coalesce(1).write.mode(
        "overwrite"
    ).text(schema_path)
    return schema


def file_stream_location(spark: SparkSession, path: str) -> tuple[str, str | None]:
    """Folder and file-name filter to stream ``path`` from.

    A file stream reads folders; a table that is a single file is found by its name
    in the folder around it.
    """
    folder, _, name = path.rstrip("/").rpartition("/")
    first = list_files(spark, path).first()
    if first is not None and first["path"].endswith(f"/{name}"):
        return folder, name
    return path, None


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """path, length and modification time of each data file; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", "modificationTime")
    )


def plain_path(path: Column) -> Column:
    """A file's path as listings write it; scans write local paths in another way."""
    return F.regexp_replace(F.regexp_replace(path, "^file:/+", "/"), "%20", " ")


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Newly landed Parquet files, each read once per checkpoint."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def stream_table(
    spark: SparkSession, name: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Rows appended to a catalog table, as a stream."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.table(name)
