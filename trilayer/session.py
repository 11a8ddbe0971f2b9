"""Session settings the library expects."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# What one task reads of a shuffle. Sorts and maps take about ten times as much memory, as
# shuffled rows are compressed.
SHUFFLE_BYTES = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(16 << 20))
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    SHUFFLE_BYTES[0]: SHUFFLE_BYTES[1],
}


GIB = 1 << 30


def sized_for(input_bytes: int) -> dict[str, str]:
    """Scan and shuffle sizes for a job over this much input.

    About half a gigabyte per scan task and a gigabyte per shuffle partition for large
    input, so that 100 TB make some 200,000 scan tasks and no more shuffle partitions
    than a driver can track. Adaptive execution merges those that turn out small.
    """
    scan = min(max(input_bytes // 10_000, 128 << 20), 512 << 20)
    partitions = min(max(-(-input_bytes // GIB), 200), 50_000)
    return {
        "spark.sql.files.maxPartitionBytes": str(scan),
        "spark.sql.shuffle.partitions": str(partitions),
    }


def build_session(
    app: str,
    master: str | None = None,
    extra: Mapping[str, str] | None = None,
    input_bytes: int | None = None,
) -> SparkSession:
    """A session with the library's settings, sized for the input if that is given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sizes = sized_for(input_bytes) if input_bytes else {}
    for key, value in {**SETTINGS, **sizes, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def bound_tasks(spark: SparkSession) -> None:
    """SHUFFLE_BYTES for a session made elsewhere, unless that names a size itself."""
    name, size = SHUFFLE_BYTES
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, size)


@contextmanager
def conf(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Set session options for the length of a block, then put the old ones back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
