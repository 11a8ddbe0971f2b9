"""Running a stream to a table and waiting for it."""

from __future__ import annotations

from collections.abc import Callable
from typing import Literal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trilayer.session import conf

# Window counts keep their state off the heap and upload only what changed.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

Mode = Literal["append", "update", "complete"]


def start_stream(
    df: DataFrame,
    checkpoint: str,
    path: str | None = None,
    table: str | None = None,
    name: str | None = None,
    mode: Mode = "append",
    interval: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start a stream into Parquet files at ``path``, registered as ``table`` if named.

    By default it reads what is there and stops; with ``interval`` (such as
    "1 minute") it goes on. In update and complete mode each micro-batch is written
    by write_batch() below, as files cannot take changed rows. ``state_partitions``
    is fixed at the first start of a checkpoint; without it the session's number of
    shuffle partitions is used.
    """
    writer = df.writeStream.option("checkpointLocation", checkpoint).outputMode(mode)
    if name:
        writer = writer.queryName(name)
    writer = (
        writer.trigger(processingTime=interval)
        if interval
        else writer.trigger(availableNow=True)
    )
    spark = df.sparkSession
    settings = {k: v for k, v in STATE_STORE.items() if spark.conf.get(k, None) is None}
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    with conf(spark, settings):
        if mode != "append":
            keep_all = mode == "update"
            return writer.foreachBatch(write_batch(path, keep_all)).start()
        writer = writer.format("parquet")
        if table:
            if path:
                writer = writer.option("path", path)
            return writer.toTable(table)
        return writer.start(path)


def write_batch(path: str, keep_all: bool) -> Callable[[DataFrame, int], None]:
    """A sink that replaces a micro-batch's own folder, so a retry changes nothing.

    ``keep_all`` keeps one folder per batch, for update mode. Otherwise two folders
    take turns, so that the last whole result stays while the next one is written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if keep_all:
            folder = f"{path}/batch_id={batch_id}"
        else:
            folder = f"{path}/slot={batch_id % 2}"
            batch = batch.withColumn("batch_id", F.lit(batch_id))
        batch.write.mode("overwrite").parquet(folder)

    return write


def read_complete(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole result of a complete-mode stream."""
    results = spark.read.parquet(path)
    newest = results.select(F.max("batch_id")).scalar()
    return results.filter(F.col("batch_id") == newest).drop("slot", "batch_id")


def finish(query: StreamingQuery, timeout: float | None = None) -> StreamingQuery:
    """Wait for an available-now stream; raises its error, or if time runs out."""
    done = query.awaitTermination(timeout)
    if done is False:
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} did not finish in time")
    failure = query.exception()
    if failure is not None:
        raise failure
    return query


def run_stream(df: DataFrame, checkpoint: str, timeout: float | None = None, **how) -> StreamingQuery:
    """start_stream() and finish()."""
    return finish(start_stream(df, checkpoint, **how), timeout)
