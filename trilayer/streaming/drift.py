"""Streams of files whose schema drifts.

The stream follows the names of landed files. For each micro-batch the schema of every new
file is read from its footer, files of one schema are read together and brought to the
table's schema. What does not fit goes into the map column ``_rescued``, by field name, as
text: fields that the table does not know, and values that its type cannot hold. So no
value is lost, and no file stops the stream.

With ``evolve`` unknown fields become columns of the table from that batch on. The schema is
kept beside the checkpoint, with one file per change; rows written before read as null.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trilayer.session import conf
from trilayer.sources.raw import read_raw
from trilayer.streaming.runner import finish

RESCUED = "_rescued"
MAP = T.MapType(T.StringType(), T.StringType())
LISTING = "path string, modificationTime timestamp, length long, content binary"
NESTED = (T.StructType, T.ArrayType, T.MapType)
# Files may have fields that differ in case only.
CASE = {"spark.sql.caseSensitive": "true"}


def load_schema(spark: SparkSession, schema_path: str) -> T.StructType | None:
    """The newest schema kept at ``schema_path``."""
    try:
        kept = spark.read.schema("number long, json string").json(schema_path)
        newest = kept.orderBy(F.col("number").desc()).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return T.StructType.fromJson(json.loads(newest["json"])) if newest else None


def save_schema(spark: SparkSession, schema_path: str, schema: T.StructType) -> None:
    """Keep a further schema; it has a column more than the last, which gives its number."""
    row = [(len(schema), schema.json())]
    spark.createDataFrame(row, "number long, json string").coalesce(1).write.mode("append").json(schema_path)


def _as_text(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BinaryType):
        return F.base64(column)
    return F.to_json(column) if isinstance(kind, NESTED) else column.cast("string")


def _fitted(name: str, found: T.StructField, wanted: T.DataType) -> tuple[Column, Column | None]:
    """The value as the wanted type, and as text if that type cannot hold it."""
    column = F.col(f"`{found.name}`")
    if found.dataType == wanted:
        return column.alias(name), None
    text = _as_text(column, found.dataType)
    if isinstance(found.dataType, (*NESTED, T.BinaryType)) or isinstance(wanted, (*NESTED, T.BinaryType)):
        return F.lit(None).cast(wanted).alias(name), text
    value = column.try_cast(wanted)
    # what came back unchanged was held; text for a number must be its own spelling
    held = value.try_cast(found.dataType).eqNullSafe(column)
    return F.when(held, value).alias(name), F.when(~held, text)


def align(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``rows`` as ``schema`` and the map ``_rescued`` of what does not fit, null if all
    does. Names are compared without case; of two fields that differ in case only, the
    second is rescued. Fields that are null are not rescued."""
    fields: dict[str, T.StructField] = {}
    extra: list[T.StructField] = []
    known = {field.name.lower() for field in schema}
    for field in rows.schema:
        if field.name.lower() in known and field.name.lower() not in fields:
            fields[field.name.lower()] = field
        else:
            extra.append(field)
    columns, rescued = [], []
    for field in schema:
        found = fields.get(field.name.lower())
        if found is None:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value, text = _fitted(field.name, found, field.dataType)
        columns.append(value)
        if text is not None:
            rescued.append((field.name, text))
    rescued += [(f.name, _as_text(F.col(f"`{f.name}`"), f.dataType)) for f in extra]
    if not rescued:
        return rows.select(*columns, F.lit(None).cast(MAP).alias(RESCUED))
    entries = F.filter(
        F.array(*[F.struct(F.lit(n).alias("key"), t.alias("value")) for n, t in rescued]),
        lambda entry: entry["value"].isNotNull(),
    )
    whole = F.when(F.size(entries) > 0, F.map_from_entries(entries))
    return rows.select(*columns, whole.alias(RESCUED))


def file_schemas(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """The files of each schema, by its JSON. Footers are read a few at a time."""
    with conf(spark, CASE), ThreadPoolExecutor(8) as pool:
        found = list(pool.map(lambda path: read_raw(spark, path).schema.json(), paths))
    groups: dict[str, list[str]] = {}
    for path, schema in zip(paths, found):
        groups.setdefault(schema, []).append(path)
    return groups


def drift_sink(
    path: str, schema_path: str, evolve: bool
) -> Callable[[DataFrame, int], None]:
    """A sink of file names that writes the rows of each micro-batch's files.

    A batch has a folder of its own, so a retry replaces what it wrote; new columns are
    kept before any row is written, so a retry finds the same schema.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        paths = sorted(r["path"] for r in batch.select("path").collect())  # files of one trigger
        groups = file_schemas(spark, paths)
        schema = load_schema(spark, schema_path)
        if evolve:
            names = {field.name.lower() for field in schema}
            added = []
            for text in groups:
                for field in T.StructType.fromJson(json.loads(text)):
                    if field.name.lower() not in names:
                        names.add(field.name.lower())
                        added.append(T.StructField(field.name, field.dataType, True))
            if added:
                schema = T.StructType([*schema.fields, *added])
                save_schema(spark, schema_path, schema)
        with conf(spark, CASE):
            whole = None
            for text, files in groups.items():
                kind = T.StructType.fromJson(json.loads(text))
                part = align(spark.read.schema(kind).parquet(*files), schema)
                whole = part if whole is None else whole.unionByName(part)
            if whole is not None:
                whole.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def ingest_drifting(
    spark: SparkSession,
    source: str,
    path: str,
    checkpoint: str,
    evolve: bool = False,
    schema: T.StructType | None = None,
    glob: str = "*.parquet",
    max_files_per_trigger: int = 64,
    timeout: float | None = None,
) -> None:
    """Bring all newly landed files of ``source`` into the table at ``path`` and stop.

    The table begins with ``schema`` or, without it, with the fields of the file that landed
    first. A later call with the same checkpoint goes on where this one ended.
    """
    schema_path = f"{checkpoint}-schema"
    if load_schema(spark, schema_path) is None:
        if schema is None:
            landed = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(source)
            first = landed.orderBy("modificationTime", "path").select("path").first()
            if first is None:
                raise ValueError(f"no file in {source} to take a schema from")
            schema = read_raw(spark, first["path"]).schema
        save_schema(spark, schema_path, schema)
    names = (
        spark.readStream.format("binaryFile").schema(LISTING).option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", max_files_per_trigger).load(source).select("path")
    )
    stream = (
        names.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        .foreachBatch(drift_sink(path, schema_path, evolve)).start()
    )
    finish(stream, timeout)


def read_drifted(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """The table under its newest schema, with ``_rescued``."""
    schema = load_schema(spark, f"{checkpoint}-schema")
    whole = T.StructType([*schema.fields, T.StructField(RESCUED, MAP)])
    return read_raw(spark, path, schema=whole).drop("batch_id")
