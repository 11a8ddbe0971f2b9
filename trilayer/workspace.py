"""Where tables, stream sinks and checkpoints of a run go.

The cluster names a shared folder in ``spark.checkpoint.dir``. Only a local-mode
session without that setting gets a folder of its own, which goes away with it.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
# Path and schema of layers written by a session, by (application, ...); release() forgets
# them.
layer_paths: dict[tuple, tuple] = {}


def shared_dir(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    app = context.applicationId
    if app in _local_dirs:
        return _local_dirs[app]
    already_set = context.getCheckpointDir()
    if already_set:
        return already_set.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a folder that all executors share"
        )
    folder = tempfile.mkdtemp(prefix="trilayer-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    _local_dirs[app] = folder
    return folder


def new_dir(spark: SparkSession, label: str) -> str:
    """A path nobody else uses; the folder itself is made by whoever writes to it."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/trilayer/{app}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table of its own: computed once, however often it is read."""
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete every table, sink and checkpoint this session put into the folder."""
    app = spark.sparkContext.applicationId
    for key in [key for key in layer_paths if key[0] == app]:
        del layer_paths[key]
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/trilayer/{app}")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(path, True)
